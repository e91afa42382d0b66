"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; results against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import embedding_dedup, jaccard_join, language_id, license_scan, media, mixing, packing, substring_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
EDGE = [None, "", " \n\t", "one", "two words", "the same text again", "the same text again", "ÀÉ naïve 日本語 text", "x" * 5000, "a " * 3000, "!!! 123 ###"]


def frame(spark, texts, **cols):
    rows = [(i, t, ("en", "de")[i % 2], ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"component_id": F.lit("x"), "score": F.lit(1), "size": F.lit(None).cast("int")})


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(60, 200))) for _ in range(30)]
    near = [re.sub(r"w7\d?\b", "changed", t) for t in base[:10]]
    joined = [base[0][:400] + " " + base[1], base[2] + "\n" + base[3], base[4], base[4], " ".join(["run"] * 130), " ".join(["run"] * 90), " ".join(["p", "q"] * 60), " ".join(["q", "p"] * 40)]
    return EDGE + base + near + joined


@pytest.fixture(scope="module")
def docs(spark, texts):
    return frame(spark, texts).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, []).limit(0)


def test_jaccard(docs, texts, empty):
    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    sets = []
    for t in texts:
        w = (t or "").encode().translate(low).split()
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    comp = list(range(len(texts)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                x, y = sorted((root(i), root(j)))
                comp[y] = x
    want = {(i, len(s), root(i)) for i, s in enumerate(sets)}
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()} == want
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_substring(docs, texts, empty):
    seen, want = set(), {}
    for i, t in enumerate(texts):
        w = (t or "").encode().split()
        keep, own = [True] * len(w), []
        for p in range(len(w) - 49):
            k = tuple(w[p : p + 50])
            own.append(k)
            if k in seen:
                keep[p : p + 50] = [False] * 50
        seen.update(own)
        want[i] = (len(w), keep.count(False), hashlib.sha256(b" ".join(x for x, k in zip(w, keep, strict=True) if k)).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_words(docs).collect()}
    assert got == want
    assert any(w[1] for w in want.values())
    assert substring_dedup.repeated_words(empty).count() == 0


def test_token_counts_and_packing(docs, texts, empty, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    ids = {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    for _ in range(2):  # the second run finds all counts in the cache
        got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, cache=str(tmp_path / "cache")).collect()}
        assert got == {i: (len((x or "").encode()), len(ids[i]), len(ids[i]) > 1024) for i, x in enumerate(texts)}
    assert docs.sparkSession.read.parquet(str(tmp_path / "cache")).count() == len({x or "" for x in texts})
    few = docs.where("doc_id % 7 = 0")  # of a large cache only this run's contents count
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(few, cache=str(tmp_path / "cache")).collect()} == {i: len(ids[i]) for i in range(0, len(texts), 7)}
    assert docs.sparkSession.read.parquet(str(tmp_path / "cache")).count() == len({x or "" for x in texts})
    assert token_counts.token_counts(empty).count() == 0

    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs).collect():
        whole = np.array(ids[r.doc_id] + [0], dtype="<u4")
        assert r.doc_tokens == len(whole) and r.ids_crc32 == zlib.crc32(whole[r.start : r.start + r.length])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert len(pieces) == len(texts)
    for parts, total in [(p, len(ids[d]) + 1) for d, p in pieces.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == total if total else at <= 1024
    assert packing.pack(empty).count() == 0


def test_encoders_agree_with_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "'s", "é", "<|endoftext|>", "　", "\xa0", "1", "23", "!", "日本", "\x1c", "\r\n", "xxxxx", " \n "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.text_lengths(texts, "byte_bpe_50k.json") == list(map(len, want))
    assert [packing._encoding("byte_bpe_50k.json").encode(x, allowed_special="all") for x in texts] == want


def test_very_long_runs_are_packed(spark):
    texts = [" " * 1_000_000, "x" + "\n" * 200_000 + "y", "a" * 120_000]
    got = packing.pack(frame(spark, texts)).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    want = token_counts.text_lengths(texts, "byte_bpe_50k.json")
    assert {r.doc_id: (r.n, r["all"]) for r in got} == {i: (n + 1, n + 1) for i, n in enumerate(want)}


def test_other_tokenizers_are_not_cut_at_spaces():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    texts = ["The  House", " a 12  b", "", "It's " * 40]
    assert token_counts.text_lengths(texts, "word_bpe_49k.json") == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_substring_of_rows_that_share_a_doc_id(spark):
    rng = random.Random(8)
    a, b, c = (" ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for _ in range(3))
    rows = [(2, a), (2, b + " " + a), (1, b), (3, c), (3, c), (3, a + " x"), (None, c), (3, None)]
    got = substring_dedup.repeated_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == sorted([(2, 80, 0), (2, 160, 80), (1, 80, 0), (3, 80, 0), (3, 80, 0), (3, 81, 80), (0, 80, 0), (3, 0, 0)])


def test_license(spark, empty):
    texts = [*EDGE, "Under THE mit-license", "under the MIT License under the mit license", "a " * 62 + "Apache License, Version 2", "mit license under the", "cc by nc"]
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, texts)).collect()}
    n = len(EDGE)
    assert [(got[n + i].n_base, got[n + i].first_word, got[n + i].last_word, got[n + i].base_labels) for i in range(5)] == [(1, 0, 0, "mit"), (2, 0, 4, "mit"), (1, 62, 62, "apache-2"), (0, None, None, ""), (1, 0, 0, "cc-by-nc")]
    assert got[n + 3].labels == "mit" and got[0].score == 0 and got[0].n_words == 0
    assert license_scan.scan(empty).count() == 0


def test_mixing(spark, docs, texts, empty):
    got = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    by = Counter()
    for i, s in enumerate(sizes):
        by[("a", "b", None)[i % 3]] += s
    target, open_, left = {}, {"a": 3, "b": 1, None: 2}, 1.5 * sum(sizes)
    while over := [s for s, w in open_.items() if left * w / sum(open_.values()) > 2 * by[s]]:
        for s in over:
            target[s] = 2.0 * by[s]
            del open_[s]
        left = 1.5 * sum(sizes) - sum(target.values())
    target |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
    taken = Counter()
    for i, s in enumerate(sizes):
        source = ("a", "b", None)[i % 3]
        assert (got[i].size, got[i].source_size) == (s, by[source]) and got[i].taken <= 2 * s
        assert got[i].target == pytest.approx(target[source])
        taken[source] += got[i].taken
    for s, x in target.items():
        assert abs(taken[s] - x) <= 0.05 * x
    assert sum(r.copies for r in got.values()) == mixing.mixed_documents(docs).count()
    assert mixing.mix_report(empty).count() == 0


def test_toxicity(spark, empty):
    rng = random.Random(2)
    words = [f"clean{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        w = rng.choices(words, k=60)
        if bad := i % 4 == 1:
            w[10:13] = ["vile", "awful", "vile"]
        rows.append(" ".join(w))
        labels.append((i, int(bad)))
    docs = frame(spark, [*rows, *EDGE])
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, lab).collect()}
    assert len(got) == len(rows) + len(EDGE)
    assert all(got[i].predicted == y for i, y in labels if got[i].held_out)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1 for i in got)
    assert got[1].segments[0].first_word <= 10 <= got[1].segments[0].first_word + got[1].segments[0].n_words
    assert toxicity.score_toxicity(empty, lab.limit(0)).count() == 0


def test_language(spark, empty):
    rng = random.Random(3)
    en, de = "the and of with house river".split(), "der und von mit haus schön".split()
    texts = [" ".join(rng.choices((en, de)[i % 2], k=20)) for i in range(200)]
    mixed = " ".join(rng.choices(en, k=40) + rng.choices(de, k=25))
    got = {r.doc_id: r for r in language_id.identify(frame(spark, [*texts, mixed, *EDGE])).collect()}
    assert all(got[i].lang_pred == ("en", "de")[i % 2] for i in range(200))
    assert [s.lang for s in got[200].spans] == ["en", "de"] and abs(got[200].spans[0].n_words - 40) <= 2
    assert [got[201 + i].lang_pred for i in (0, 1, 2, 10)] == ["und"] * 4
    assert language_id.identify(empty).count() == 0
    kept = language_id.accepted(frame(spark, [*texts, *EDGE]))
    assert kept.columns == frame(spark, []).columns and kept.count() == 200 + len([t for t in EDGE if t and re.search(r"[^\W\d_]", t)])


@pytest.mark.parametrize("kind", ["double", "float"])
def test_vectors(spark, kind):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 64))
    near = base[:15] + 0.03 * rng.normal(size=(15, 64))
    v = [*base.tolist(), *near.tolist(), *(3 * base[:5]).tolist(), base[0].tolist()]
    bad = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] + [1.0] * 63]
    df = spark.createDataFrame(list(enumerate([*v, *bad])), f"vec_id long, embedding array<{kind}>").withColumn("n_links", F.lit("x"))
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df).collect()}
    x = np.array(v)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    assert [got[i].n_links for i in range(len(v))] == (link.sum(axis=1) - 1).tolist()
    assert all(got[len(v) + i].n_links == 0 and got[len(v) + i].kept for i in range(len(bad)))
    assert [got[40 + i].component_id for i in range(15)] == list(range(15))
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_media(spark):
    rng = np.random.default_rng(6)
    v = spark.createDataFrame([(i, rng.normal(size=64).tolist()) for i in range(60)], "vec_id long, embedding array<double>")
    lib = media.rendered(v)
    got = {r.query_id: r for r in media.matching_images(media.rendered(v.where("vec_id % 5 = 0"), edit=True), lib).collect()}
    assert len(got) == 12 and sum(r.best_id == q for q, r in got.items()) >= 11
    odd = spark.createDataFrame([(1, None), (2, b""), (3, b"P5\n9 9\n255\n" + b"0" * 81), (4, b"junk")], "id long, image binary")
    assert {r.n_matches for r in media.matching_images(odd, lib).collect()} == {0}
