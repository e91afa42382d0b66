"""Language identification against brute force, and texts and numbers of languages of any size."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string"


def best_path(scores, penalty):
    """Over all sequences of labels: the best total."""
    n, k = scores.shape
    return max(sum(scores[t, c] for t, c in enumerate(path)) - penalty * sum(a != b for a, b in itertools.pairwise(path)) for path in itertools.product(range(k), repeat=n))


def total(scores, path, penalty):
    return sum(scores[t, c] for t, c in enumerate(path)) - penalty * sum(a != b for a, b in itertools.pairwise(path))


@pytest.mark.parametrize("k", [2, 3, 4])
def test_viterbi_is_the_best_of_all_paths(k, monkeypatch):
    monkeypatch.setattr(li, "SEGMENT", 2)
    rng = np.random.default_rng(k)
    counts = np.array([5, 0, 1, 7, 6, 3])
    for penalty in (0.0, 0.5, 2.0, 8.0):
        scores = rng.normal(scale=3, size=(counts.sum(), k)).astype(np.float32)
        label = li.viterbi(scores, counts, penalty)
        for end, n in zip(np.cumsum(counts), counts, strict=True):
            if n:
                part = scores[end - n : end]
                assert total(part, label[end - n : end], penalty) == pytest.approx(best_path(part, penalty), abs=1e-4)


def model(k=3, seed=0):
    rng = np.random.default_rng(seed)
    logp = np.log(rng.dirichlet(np.full(64, 0.3), size=k))[:, rng.integers(0, 64, li.BUCKETS)].astype(np.float32)
    left = np.ones((li.SCRIPTS, k), bool)
    left[3] = [i == 0 for i in range(k)]
    left[5] = False
    return [f"l{i}" for i in range(k)], logp, left


def test_long_texts_in_pieces_are_as_whole(monkeypatch):
    rng = random.Random(4)
    words = ["house", "straße", "река", "日本", "ab", "zz", "été", "שלום", "—"]
    text = " ".join("".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(3000))
    labels = li.Labels(model(), 4.0)
    whole = labels.of(pa.array([text]))
    monkeypatch.setattr(li, "LONGEST_WORD", 128)
    for limit in (200, 1111, 10_000):
        for a, b in zip(whole, labels.of_long(pa.array([text]), limit), strict=True):
            assert np.array_equal(a, b)


def test_only_candidates_of_the_script_are_scored():
    m = model()
    counts, bucket, start, script = li._words(pa.array(["река house שלום", None, ""]))
    assert counts.tolist() == [3, 0, 0] and script.tolist() == [3, 1, 5]
    scores = li.word_scores(m, bucket, start, script)
    assert scores[0].tolist() == [0, li.OFF_SCRIPT, li.OFF_SCRIPT] and scores.max(axis=1).tolist() == [0, 0, 0]
    assert (scores[1:] > li.OFF_SCRIPT).sum() > 3


def test_runs_longer_than_a_word_are_several(monkeypatch):
    monkeypatch.setattr(li, "LONGEST_WORD", 10)
    counts, bucket, start, _ = li._words(pa.array(["x" * 25 + " " + "é" * 11, "abc"]))
    assert counts.tolist() == [6, 1] and len(bucket) == 25 + 22 + 3
    assert start.tolist() == [0, 10, 20, 25, 35, 45, 47]


def test_more_languages_than_a_byte_holds(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        own = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(6)]
        rows += [(i * 8 + j, " ".join(rng.choices(own, k=12)), f"lang{i}") for j in range(8)]
    rows += [(10_000, None, "lang0"), (10_001, "abc", None), (None, "abc", "lang1")]
    got = {r.doc_id: r for r in li.identify(spark.createDataFrame(rows, SCHEMA)).collect() if r.doc_id is not None}
    assert sum(got[d].lang_pred == lang for d, t, lang in rows[:2400]) >= 2390
    assert got[10_000].lang_pred == "und"


def test_a_rare_language_is_learned(spark):
    rng = random.Random(2)
    en, fi = "the and of with house river".split(), "ja on ei talo joki metsä".split()
    rows = [(i, " ".join(rng.choices(en, k=8)), "en") for i in range(3000)] + [(5000 + i, " ".join(rng.choices(fi, k=8)), "fi") for i in range(12)]
    got = li.identify(spark.createDataFrame(rows, SCHEMA), train_rows=40).collect()
    assert all(r.lang_pred == ("en" if r.doc_id < 3000 else "fi") for r in got)


def test_accepted_keeps_mixed_texts_and_clashing_columns(spark):
    rng = random.Random(3)
    lang = {"en": "the and of with house river".split(), "de": "der und von mit haus schön".split(), "fi": "ja on ei talo joki metsä".split(), "fr": "le et de avec maison où".split()}
    rows = [(i, " ".join(rng.choices(w, k=20)), name, "x") for i in range(40) for name, w in lang.items()]
    rows += [(100, " ".join(" ".join(rng.choices(w, k=30)) for w in lang.values()), "en", "x"), (101, "река дом " * 9, None, "x"), (102, None, None, None), (103, "12 !", "en", "x")]
    docs = spark.createDataFrame(rows, SCHEMA + ", lettered string")
    kept = li.accepted(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id >= 100) == [100] and kept.count() == 161
