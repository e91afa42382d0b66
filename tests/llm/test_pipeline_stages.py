"""Stages of the pipeline against brute force, at the values that the pipeline uses."""

import random
from collections import Counter

import corpus_pipeline

WIDE = "doc_id long, text string, lang string, source string, n_chars int, base int, cut string, picked int, mix_size int, row string, text_key int, kept string, stays int"


def wide(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), 1, "c", None, 7, "r", 1, "k", 0) for d, t, s in rows], WIDE).repartition(3)


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_rows_that_share_a_doc_id_lose_nothing(spark):
    rng = random.Random(1)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(120)) for _ in range(4))
    docs = wide(spark, [(2, a, "x"), (1, a, "x"), (2, b, "y"), (3, c, None), (3, c, "x"), (3, d, "x"), (None, d + " more", "x"), (None, None, "x"), (None, "", "x")])
    near = corpus_pipeline.near_duplicates(spark, docs, "")
    assert near.columns == docs.columns
    assert pairs(near) == Counter({(1, a): 1, (2, b): 1, (3, c): 1, (3, d): 1, (None, None): 1, (None, ""): 1})


def test_repeated_passages_of_rows_that_share_a_doc_id(spark):
    rng = random.Random(2)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(70)) for _ in range(4))
    docs = wide(spark, [(1, a, "x"), (3, f"{a} {b} zz", "x"), (3, c, "x"), (4, f"{d} {c}", "x"), (4, d, "y"), (None, a, "x"), (5, b, "x"), (6, None, "x"), (6, "", "x")])
    out = corpus_pipeline.repeated_passages(spark, docs, "")
    assert out.columns == docs.columns
    assert pairs(out) == Counter({(1, a): 1, (3, f"{b} zz"): 1, (3, c): 1, (4, d): 2, (None, a): 1, (6, None): 1, (6, ""): 1})
    assert all(r.n_chars == len(r.text or "") for r in out.collect())


def test_mix_with_clashing_columns(spark):
    docs = wide(spark, [(i % 30, f"word {i} " * (i % 7 + 1), ("a", "b", None)[i % 3]) for i in range(90)])
    out = corpus_pipeline.mixed_sources(spark, docs, "")
    assert out.columns == docs.columns and set(pairs(out)) <= set(pairs(docs))
    assert all((r.base, r.cut, r.picked, r.mix_size, r.row) == (1, "c", None, 7, "r") for r in out.collect())


def test_all_stages_on_an_empty_table_and_on_few_rows(spark):
    for rows in ([], [(1, "the house by the river", "x"), (1, "the house by the river", "x"), (None, None, None), (2, "", "y"), (3, "a " * 3000, None)]):
        docs = wide(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
        assert (docs.count() > 0) == bool(rows)


def test_near_duplicates_are_four_fifths_of_five_words(spark):
    rng = random.Random(8)
    texts = [None, "", "one", "two words", "two words", "a b c d e", "a b c d e f"]
    for n in (60, 120, 200):
        for edits in range(9):
            base = [f"v{rng.randrange(10**6)}" for _ in range(n)]
            copy = list(base)
            for at in rng.sample(range(n), edits):
                copy[at] = f"changed{rng.randrange(10**6)}"
            texts += [" ".join(base), " ".join(copy)]

    def shingles(text, k):
        w = (text or "").split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    def kept(k, percent):
        sets, comp = [shingles(t, k) for t in texts], list(range(len(texts)))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    low, high = sorted((comp[i], comp[j]))
                    comp = [low if c == high else c for c in comp]
        return {i for i, c in enumerate(comp) if i == c}

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == kept(5, 80)
    assert kept(5, 80) < kept(3, 90)
