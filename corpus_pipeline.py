"""From raw documents to packed training sequences; each stage calls one operator of barloom.llm.

Every stage takes what its predecessor kept and returns rows with the columns of documents, the last one
pieces of packed sequences. No stage can be stated as a whole in SQL (language models, a tokenizer), so
there is no oracle; tests compare near duplicates, repeated passages, the mix and the packing with brute force.

Defined results: rows are told apart by doc_id and text, so texts that share a doc_id are different documents;
a null doc_id is a document like others, but no source of repeated passages; null, empty and wordless texts have no
language and go first; further columns, whatever their names, are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import jaccard_join, language_id, mixing, packing, substring_dedup
from barloom.llm.common import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or most of whose words are in a script that no known language is written in, go."""
    return language_id.accepted(docs, least=0.5)


def _rows(docs: DataFrame) -> DataFrame:
    """All columns in one struct, so that none of their names can clash, with what a row is told apart by."""
    text = F.col("text").cast("string")
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"))


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, that with the smallest doc_id; wordless texts stay.

    Near copies share four fifths of their 5-word shingles; the narrower 3 words and 90 % are op9's own. Of rows that are
    equal in doc_id and text one stays.
    """
    found = materialize(jaccard_join.jaccard_components(docs, k=5, percent=80).where("component_row is not null").select("doc_id", "text_key", "row_id", "component_row"), "near")
    first = found.groupBy("component_row").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select(F.col("component_row").alias("c"), F.col("f.row_id").alias("stays")), "kept-of-components")
    marked = found.join(first, F.col("component_row") == F.col("c")).groupBy("doc_id", "text_key").agg(F.max((F.col("row_id") == F.col("stays")).cast("int")).alias("stays"), F.count("*").alias("n"))
    # rows that go, or of which one copy stays
    marked = materialize(marked.where("stays = 0 or n > 1"), "near-marked")
    rows = _rows(docs)
    whole = rows.join(marked, _same(rows, marked), "left_anti").select("row.*")
    again = marked.where("stays = 1")
    once = rows.join(again, _same(rows, again), "left_semi").select("row", "doc_id", F.col("row.text").alias("text")).groupBy("doc_id", "text").agg(F.first("row").alias("row"))
    return whole.unionByName(once.select("row.*"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that an earlier document has go; documents of which nothing is left go."""
    cut = substring_dedup.repeated_words(docs).where("n_removed > 0").select("doc_id", "text_key", "kept_text")
    cut = cut.groupBy("doc_id", "text_key").agg(F.first("kept_text").alias("kept"))
    rows = _rows(docs)
    out = rows.join(cut, _same(rows, cut), "left").where("kept is null or kept <> ''")
    row = F.col("row")
    new = {"text": F.col("kept")} | ({"n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return out.select(*[F.when(F.col("kept").isNull(), row[c]).otherwise(new[c]).alias(c) if c in new else row[c].alias(c) for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights; a document that the mix takes twice is two rows."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, each document with its end token, as packing.pack gives them; null texts are the end token alone."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
