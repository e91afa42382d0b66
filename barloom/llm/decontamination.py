"""Benchmark decontamination over a distributed positional inverted index, with DataFrame functions only.

Phrases: every run of ``width`` consecutive words of an item; an item with fewer words, but not none, is one phrase.

Index: postings (term, document, position) of training tokens, written once, for the terms that the searches start from: of each phrase its
``lists`` rarest occurrences of terms by corpus frequency. A phrase one of whose terms the corpus lacks needs no list. Postings also have a
slot: a term with many postings has several, and the phrases that start from it go to each, so no task holds all postings of a term.

Search: the list of a phrase's rarest term, each position less the term's offset in the phrase, gives possible starts; each further list,
less its own offset, is intersected with them on (document, term, position), rarest first. Each list is longer than those before it, so two are
the default. What is left is held against all words of the document, so matches are exact. Proximity matches meet the further lists within
``slop`` words of the expected places instead; both sides are dealt into bins of positions, so a list of a long document is not paired
with itself as a whole.

Defined results: null and wordless texts have no words and no hits; rows are told apart by doc_id and text, and equal rows get equal results without
meeting each other; a null doc_id is a value like others; an item is its item_id as a string (null: an empty one), so rows that share an item_id are one
item; other columns, whatever their names, are not read. No hit: the digest is that of an empty list.

Sizes: terms of the items are sent to all tasks only where their number and bytes are below MOST_TERMS and MOST_BYTES, which is counted; beyond
that tokens are joined by a shuffle, counts of them pre-aggregated. A document's own candidates meet in one row: lists agree on few starts that are not
matches, so there are about as many as it has words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Separators one by one, which Java's patterns look up in a table of bits; ranges would be tried in turn.
_SEPARATORS = "".join(f"\\x{b:02X}" for b in range(128) if not chr(b).isalnum())
WORD, SEPARATOR = f"[^{_SEPARATORS}]+", f"[{_SEPARATORS}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms that are broadcast at most; more are joined by a shuffle.
MOST_TERMS, MOST_BYTES = 500_000, 16 << 20
#: Documents with possible starts, two numbers each, that are broadcast at most to pick their texts; with more, all texts are shuffled.
MOST_KEYS = 300_000
#: Postings of a term in one slot.
SLOT = 50_000


def _lower(text: Column) -> Column:
    """A-Z only; where all is ASCII, that is what lower does, only faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: str = "text") -> Column:
    """The words in order; before the first and after the last there may be an empty one, which is no term and equals none."""
    return F.split(_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), SEPARATOR)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once a row, also where inner functions name it; a column would be put in its place anew for each element."""
    return F.transform(F.array(value), use)[0]


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """What rows are told apart by, none of it null: doc_id (null: 0) and a 64-bit hash of the text and of whether doc_id is null."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc"), F.xxhash64(F.col("text").cast("string"), doc_id.isNull()).alias("key"), *more)


def phrases(items: DataFrame, width: int) -> DataFrame:
    """(phrase, item) of all items, each once; a phrase's words are one space apart."""
    runs = _once(F.array_remove(words(), ""), lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - width + 1, F.lit(1))), lambda at: F.array_join(F.slice(w, at, F.lit(width)), " ")))
    return items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.explode(runs).alias("phrase")).where("phrase <> ''").distinct()


def _small(terms: DataFrame) -> DataFrame:
    """A stored table of distinct terms, marked for a broadcast if it is below the bounds."""
    n, size = terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    return F.broadcast(terms) if n <= MOST_TERMS and size <= MOST_BYTES else terms


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often the corpus has each of the terms; those that it lacks are not there."""
    tokens = docs.select(F.explode(words()).alias("token"))
    counts = tokens.join(_small(terms), F.col("token") == F.col("term"), "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    return counts.withColumnRenamed("token", "term")


def plans(texts: DataFrame, docs: DataFrame, lists: int) -> DataFrame:
    """(phrase, terms): of each phrase that can occur its ``lists`` rarest (n, at, term), rarest first; at is the term's offset."""
    each = texts.select("phrase").distinct().select("phrase", F.posexplode(F.split("phrase", " ")).alias("at", "term"))
    counts = materialize(term_counts(docs, materialize(each.select("term").distinct(), "item-terms")), "term-counts")
    each = each.join(_small(counts), "term", "left")
    ranked = each.groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "term"))).alias("terms"))
    return ranked.where(F.col("terms")[0]["n"] > 0).select("phrase", F.slice("terms", 1, lists).alias("terms"))


def _slots() -> Column:
    return (F.floor(F.col("n") / SLOT) + 1).cast("int")


def postings(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """(term, slot, doc, key, pos) of all places in the corpus that have a term of the plan."""
    terms = materialize(plan.select(F.explode("terms").alias("t")).select("t.term", "t.n").distinct().select("term", _slots().alias("slots")), "list-terms")
    tokens = _keyed(docs, words().alias("w")).select("doc", "key", F.posexplode("w").alias("pos", "token"))
    found = tokens.join(_small(terms), F.col("token") == F.col("term"))
    return found.select("term", F.pmod(F.hash("doc", "key", "pos"), F.col("slots")).alias("slot"), "doc", "key", "pos")


def _starts(index: DataFrame, plan: DataFrame) -> DataFrame:
    """(doc, key, start, phrase, terms): the rarest list's positions less the offset."""
    first = F.col("terms")[0]
    seek = plan.select("phrase", "terms", first["term"].alias("term"), first["at"].alias("at"), first["n"].alias("n"))
    seek = seek.select("phrase", "terms", "term", "at", F.explode(F.sequence(F.lit(0), _slots() - 1)).alias("slot"))
    return index.join(seek, ["term", "slot"]).select("doc", "key", (F.col("pos") - F.col("at")).alias("start"), "phrase", "terms").distinct()


def _further(k: int) -> Column:
    """The phrase's k-th list; the first again where it has fewer."""
    return F.coalesce(F.get("terms", F.lit(k)), F.col("terms")[0])


def phrase_starts(index: DataFrame, plan: DataFrame, lists: int) -> DataFrame:
    """(doc, key, start, phrase) where all lists of a phrase agree."""
    found = _starts(index, plan).where("start >= 0")
    there = index.select(F.col("doc").alias("_doc"), F.col("key").alias("_key"), F.col("term").alias("_term"), "pos")
    for k in range(1, lists):
        found = found.withColumns({"seek": _further(k)["term"], "place": F.col("start") + _further(k)["at"]})
        found = found.join(there, (F.col("doc") == F.col("_doc")) & (F.col("key") == F.col("_key")) & (F.col("seek") == F.col("_term")) & (F.col("place") == F.col("pos")), "left_semi")
    return found.select("doc", "key", "start", "phrase")


def near_starts(index: DataFrame, plan: DataFrame, lists: int, slop: int) -> DataFrame:
    """(doc, key, start, phrase) where every further list has a position at most ``slop`` words from its place."""
    bins = 2 * slop + 1
    found = _starts(index, plan)
    there = index.select(F.col("doc").alias("_doc"), F.col("key").alias("_key"), F.col("term").alias("_term"), "pos", F.floor(F.col("pos") / bins).alias("_bin"))
    for k in range(1, lists):
        place = F.col("start") + _further(k)["at"]
        found = found.withColumns({"seek": _further(k)["term"], "place": place, "bin": F.explode(F.array_distinct(F.array(F.floor((place - slop) / bins), F.floor((place + slop) / bins))))})
        equal = (F.col("doc") == F.col("_doc")) & (F.col("key") == F.col("_key")) & (F.col("seek") == F.col("_term")) & (F.col("bin") == F.col("_bin"))
        found = found.join(there, equal & (F.abs(F.col("pos") - F.col("place")) <= slop), "left_semi")
    return found.select("doc", "key", "start", "phrase").distinct()


def _verified(docs: DataFrame, starts: DataFrame) -> DataFrame:
    """(doc, key, n_hit, phrases) of documents with exact matches: starts held against all words."""
    held = materialize(starts.groupBy("doc", "key").agg(F.collect_set(F.struct("start", "phrase")).alias("found")), "possible-starts")
    keys = held.select("doc", "key")
    # few documents are possible as a rule: then only their texts are shuffled
    rows = _keyed(docs, F.col("text")).join(F.broadcast(keys) if held.count() <= MOST_KEYS else keys, ["doc", "key"], "left_semi")
    length = lambda c: F.size(F.split(c["phrase"], " "))
    exact = _once(words(), lambda w: F.filter("found", lambda c: F.array_join(F.slice(w, c["start"] + 1, length(c)), " ") == c["phrase"]))
    rows = rows.join(held, ["doc", "key"]).select("doc", "key", exact.alias("found"))
    places = F.array_distinct(F.flatten(F.transform("found", lambda c: F.sequence(c["start"], c["start"] + length(c) - 1))))
    rows = rows.select("doc", "key", F.size(places).cast("long").alias("n_hit"), F.array_distinct(F.transform("found", lambda c: c["phrase"])).alias("phrases"))
    # the condition stands after the aggregate: before it, it would become part of the join, of which one side lacks the text
    return rows.groupBy("doc", "key").agg(F.first("n_hit").alias("n_hit"), F.first("phrases").alias("phrases")).where("n_hit > 0")


def _items_of(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, key, items), sorted as strings, of rows (doc, key, phrase)."""
    return found.distinct().join(texts, "phrase").groupBy("doc", "key").agg(F.array_sort(F.collect_set("item")).alias("items"))


def matched(docs: DataFrame, items: DataFrame, width: int = 10, lists: int = 2, slop: int = 2) -> DataFrame:
    """(doc, key, n_hit, items, near_items) of documents with a match; n_hit and items are null where no match is exact."""
    texts = materialize(phrases(items, width), "phrases")
    plan = materialize(plans(texts, docs, lists), "search-plan")
    index = materialize(postings(docs, plan), "postings")
    exact = materialize(_verified(docs, phrase_starts(index, plan, lists)), "exact-matches")
    near = _items_of(near_starts(index, plan, lists, slop).select("doc", "key", "phrase"), texts).withColumnRenamed("items", "near_items")
    hits = exact.select("doc", "key", "n_hit").join(_items_of(exact.select("doc", "key", F.explode("phrases").alias("phrase")), texts), ["doc", "key"])
    return materialize(near.join(hits, ["doc", "key"], "full"), "matches")


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items and near_items of each row of ``docs`` (doc_id, text).

    near_items: items with a proximity match of one of their phrases in the document, exact ones included.
    """
    docs = docs.select("doc_id", "text")
    found, none = matched(docs, items, **options), F.array().cast("array<string>")
    out = _keyed(docs, F.col("doc_id"), n_words().alias("n_words")).join(found, ["doc", "key"], "left")
    out = out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items", "near_items")


def clean_documents(docs: DataFrame, items: DataFrame, most: float = 0.0, **options) -> DataFrame:
    """The rows of ``docs`` at most a share ``most`` of whose words are hit, columns as given."""
    found = matched(docs.select("doc_id", "text"), items, **options).where("n_hit > 0").select("doc", "key", "n_hit")
    rows = _keyed(docs, F.struct(*[docs[c] for c in docs.columns]).alias("row")).join(found, ["doc", "key"], "left")
    return rows.where(F.col("n_hit").isNull() | (F.col("n_hit") <= n_words("row.text") * most)).select("row.*")
