"""Toxicity: segments and scores against brute force, and the time of the scan."""

import random
import time
from math import exp, inf, log

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from barloom.llm import toxicity as tx


def brute_segments(scores):
    """The contiguous stretch with the largest sum (shortest, leftmost), then the same left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or total > best[0] + 1e-12 or (abs(total - best[0]) <= 1e-12 and j - i < best[2] - best[1])):
                best = (total, i, j)
    if best is None:
        return []
    _, i, j = best
    return brute_segments(scores[:i]) + [(i, j, best[0])] + [(a + j + 1, b + j + 1, s) for a, b, s in brute_segments(scores[j + 1 :])]


@pytest.mark.parametrize("seed", range(60))
def test_segments_are_all_maximal_ones(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 40))
    hits = np.flatnonzero(rng.random(n) < rng.choice([0.1, 0.4, 0.8]))
    score = rng.uniform(0.05, 1.0, len(hits))
    drift = -float(rng.choice([0.1, 0.35, 0.9]))
    row = [drift] * n
    for i, x in zip(hits, score, strict=True):
        row[i] = x
    got = tx.maximal_segments(hits, score, drift)
    want = brute_segments(row)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_the_scan_is_linear():
    def took(n, kind):
        at = np.arange(n) * (400 if kind == "sparse" else 2)
        score = np.full(n, 5.0) if kind == "sparse" else np.linspace(0.3, 0.1, n)
        t = time.perf_counter()
        tx.maximal_segments(at, score, -0.1 if kind == "sparse" else -0.2)
        return time.perf_counter() - t

    for kind in ("sparse", "dense"):
        small, large = min(took(10_000, kind) for _ in range(3)), min(took(80_000, kind) for _ in range(3))
        assert large < 24 * small + 0.05


def test_scores_against_a_plain_version():
    rng = random.Random(1)
    words = [f"word{i}" for i in range(30)] + ["vile", "vilest", "awful"]
    texts = [None, "", "  !", *(" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40))]
    buf = [tx._features(pa.array([w]))[1] for w in ("vile", "vilest")]
    model = tx.Model(np.array([buf[0][0][0], buf[1][1][0]]), np.array([2.0, 3.5]))  # the word "vile", and words that begin with "vile"
    model.scale, model.location = 1.3, 2.0

    class Shared:
        value = model

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    got = pa.Table.from_batches(list(tx._scorer(Shared)([batch]))).to_pylist()
    for r, text in zip(got, texts, strict=True):
        w = [x for x in (text or "").split() if x != "!"]
        row = [2.0 if x == "vile" else 3.5 if x == "vilest" else tx.DRIFT for x in w]
        want = brute_segments(row)
        assert [(s["first_word"], s["first_word"] + s["n_words"] - 1) for s in r["segments"]] == [s[:2] for s in want]
        z = [s[2] * 1.3 - 2.0 - log(max(len(w), 1)) for s in want]
        assert r["evidence"] == pytest.approx(max(0.0, log(sum(map(exp, z)))) if z else 0.0) and r["n_words"] == len(w)


def test_calibration_is_the_best_curve():
    rng = np.random.default_rng(3)
    n = 400
    toxic = rng.integers(0, 2, n)
    binned = pd.DataFrame({"toxic": toxic, "top": np.round(np.where(toxic, rng.gumbel(6, 1, n), rng.gumbel(1, 1, n)).clip(0), 1), "ln": 4.0, "w": 1})
    model = tx.Model(np.empty(0, np.uint64), np.empty(0))
    loss = tx.calibrate(model, binned)
    x = np.maximum(0, np.where(binned["top"] > 0, binned["top"] * model.scale - model.location - 4.0, 0))

    def penalised(a, b):
        p = 1 / (1 + np.exp(-(a + b * x)))
        return -(toxic * np.log(p) + (1 - toxic) * np.log(1 - p)).sum() + 0.25 * ((a + 3) ** 2 + (b - 1) ** 2)

    best = min(penalised(a, b) for a in np.linspace(-6, 2, 81) for b in np.linspace(0.05, 3, 60))
    assert penalised(*model.curve) <= best + 1e-6 and 0 < loss < inf
