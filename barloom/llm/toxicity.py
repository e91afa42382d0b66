"""Toxic passages by maximum-scoring segments.

Every word gets the log-odds of standing in a toxic rather than a clean document, with Dirichlet priors; all
maximal segments of a text's word scores are found in one linear scan (positive stretches that no extension
improves). Segment scores of clean text follow an extreme-value law, whose parameters turn a segment's
score into an expected number of chance segments; a text's evidence sums over its segments, and a
logistic curve gives the probability of the toxic label.

Learned from labelled rows of the given fold only, at most about ``train_rows`` of them, drawn by a hash of
doc_id: two of the three training folds give the counts; the third chooses how strong a feature must be (``GRID``), by the
smallest logistic loss, and gives the extreme-value and logistic parameters. The features are words and word beginnings
(so that inflected forms share evidence). A feature stands in at least ``LEAST_TOXIC`` of the drawn toxic documents, so the
model is no larger than these few documents' words, however large the corpus is.

Defined results: null, empty and wordless texts have no segments and the base score; a null doc_id is not
learned from; several labels of one doc_id count as the largest; repeated documents give one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U64, chunks, class_table, text_arrays, word_hashes, word_spans

WORD = class_table(bytes([*range(0x61), *range(0x7B, 0x80)]))
#: Beginnings of so many bytes are features too.
BEGINNINGS = (4, 5, 6)
TRAIN_ROWS, LEAST_TOXIC = 40_000, 3
#: Dirichlet prior: so many further documents show a feature, of either label in proportion.
PRIOR = 3.0
#: Least z-score and least log-odds of a feature: the choices.
GRID = ((2.5, 1.0), (3.0, 1.5), (3.5, 2.0), (4.5, 2.5), (6.0, 3.0))
MOST_WEIGHT = 6.0
#: What a word without evidence adds; negative, so that segments end.
DRIFT = -0.1
RESULT = "doc_id long, n_words int, evidence double, segments array<struct<first_word:int,n_words:int,score:double>>"


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def _features(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per text, and the hash of every word and of its beginnings (0: the word is shorter)."""
    raw, offsets = text_arrays(texts)
    buf = LOWER[raw]
    s, e, counts = word_spans(buf, offsets, WORD)
    out = [word_hashes(buf, s, e)]
    for n in BEGINNINGS:
        h = word_hashes(buf, s, np.minimum(e, s + n), seed=100 + n)
        out.append(np.where(e - s > n, h, U64(0)))
    return counts, out


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) rows to features with the documents of either label that show them."""
    for batch in batches:
        for part in chunks(batch):
            toxic = np.asarray(part.column(0)).astype(np.int64)
            counts, features = _features(part.column(1))
            doc = np.repeat(np.arange(len(counts)), counts)
            name, at = np.concatenate(features), np.tile(doc, len(features))
            order = np.lexsort((at, name))
            name, at = name[order], at[order]
            new = np.ones(len(name), bool)
            new[1:] = (name[1:] != name[:-1]) | (at[1:] != at[:-1])
            name, bad = name[new], toxic[at[new]]
            if not len(name):
                continue
            first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
            t = np.add.reduceat(bad, first)
            n = np.diff(np.append(first, len(name)))
            yield pa.RecordBatch.from_arrays([pa.array(name[first].view(np.int64)), pa.array(t), pa.array(n - t)], ["feature", "t", "c"])


def maximal_segments(at: np.ndarray, score: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a row of scores that are ``drift`` but at the given places, where they are positive.

    Linear time: each new positive stretch is merged with earlier ones while that raises the score, and each segment
    knows the nearest earlier one with a smaller sum before it, so none between is looked at again.
    """
    found: list[list[float]] = []  # first, last, sum before, sum after
    smaller: list[int] = []
    total, last = 0.0, -1
    for i, x in zip(at.tolist(), score.tolist(), strict=True):
        total += drift * (i - last - 1)
        seg = [i, i, total, total + x]
        total, last = total + x, i
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= seg[2]:
                j = smaller[j]
            if j < 0 or found[j][3] >= seg[3]:
                found.append(seg)
                smaller.append(j)
                break
            seg, before = [found[j][0], seg[1], found[j][2], seg[3]], smaller[j]
            del found[j:], smaller[j:]
            j = before
    return [(int(a), int(b), r - l) for a, b, l, r in found]


class Model:
    """Weights by feature hash (sorted), extreme-value scale and location per word, and the logistic curve."""

    def __init__(self, names: np.ndarray, weights: np.ndarray):
        order = np.argsort(names)
        self.names, self.weights = names[order], weights[order]
        self.scale, self.location = 1.0, 0.0
        self.curve = (-3.0, 1.0)

    def word_scores(self, features: list[np.ndarray]) -> np.ndarray:
        best = np.full(len(features[0]), DRIFT)
        if len(self.names):
            for f in features:
                i = np.minimum(np.searchsorted(self.names, f), len(self.names) - 1)
                best = np.maximum(best, np.where(self.names[i] == f, self.weights[i], DRIFT))
        return best

    def evidence(self, segments: list[tuple[int, int, float]], n_words: int) -> float:
        """Log of the summed rarity of the segments: minus the log of the number expected by chance."""
        if not segments:
            return 0.0
        z = np.array([s[2] for s in segments]) * self.scale - self.location - np.log(max(n_words, 1))
        return float(max(0.0, np.logaddexp.reduce(z)))

    def probability(self, evidence: Column | np.ndarray):
        return self.curve[0] + self.curve[1] * evidence


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in chunks(batch):
                counts, features = _features(part.column(1))
                score = model.word_scores(features)
                first = np.cumsum(counts) - counts
                hit = np.flatnonzero(score > 0)
                of = np.searchsorted(first + counts, hit, "right")
                edges = np.searchsorted(of, np.arange(len(counts) + 1))
                segments, evidence = [], np.zeros(len(counts))
                for d in range(len(counts)):
                    a, b = edges[d], edges[d + 1]
                    found = maximal_segments(hit[a:b] - first[d], score[hit[a:b]], DRIFT) if b > a else []
                    evidence[d] = model.evidence(found, int(counts[d]))
                    segments.append([{"first_word": x, "n_words": y - x + 1, "score": z} for x, y, z in found])
                kind = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts.astype(np.int32)), pa.array(evidence), pa.array(segments, kind)], ["doc_id", "n_words", "evidence", "segments"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit with a weak pull to a = -3, b = 1."""
    at, prior = np.array([-3.0, 1.0]), np.array([-3.0, 1.0])
    m = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ at, -30, 30)))
        g = m.T @ (w * (y - p)) - 0.5 * (at - prior)
        h = (m * (w * p * (1 - p))[:, None]).T @ m + 0.5 * np.eye(2)
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        at = at + step
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(max(at[1], 1e-3))


def _tops(shared):
    """(toxic, text) rows to (toxic, choice, words, largest segment) under each choice of features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, choice = shared.value
        models = [Model(names[choice >= g], weights[choice >= g]) for g in range(len(GRID))]
        for batch in batches:
            for part in chunks(batch):
                counts, features = _features(part.column(1))
                first = np.cumsum(counts) - counts
                for g, model in enumerate(models):
                    score = model.word_scores(features)
                    hit = np.flatnonzero(score > 0)
                    edges = np.searchsorted(np.searchsorted(first + counts, hit, "right"), np.arange(len(counts) + 1))
                    top = [max((z for *_, z in maximal_segments(hit[a:b] - first[d], score[hit[a:b]], DRIFT)), default=0.0) for d, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([g] * len(counts), pa.int32()), pa.array(counts.astype(np.int32)), pa.array(top, pa.float64())], ["toxic", "choice", "n_words", "top"])

    return run


def calibrate(model: Model, binned: pd.DataFrame) -> float:
    """Fit the extreme-value law of clean documents' largest segments, then the logistic curve; the mean logistic loss.

    ``binned``: toxic, top (largest segment), ln (log of the words), w (documents).
    """
    clean = binned[binned["toxic"] == 0]
    if len(clean) and clean["w"].sum() > 1:
        # largest segments, less the growth with the length: mean and deviation give the law
        mean = np.average(clean["top"], weights=clean["w"])
        sd = max(0.5, float(np.sqrt(np.average((clean["top"] - mean) ** 2, weights=clean["w"]))))
        model.scale = float(np.pi / (sd * np.sqrt(6)))
        # location per word: n exp(-location) exp(-scale x) chance segments above x
        model.location = float(model.scale * mean - 0.5772 - np.average(clean["ln"], weights=clean["w"]))
    x = np.maximum(0.0, np.where(binned["top"] > 0, binned["top"] * model.scale - model.location - binned["ln"], 0.0)).astype(float)
    y, w = binned["toxic"].to_numpy(float), binned["w"].to_numpy(float)
    model.curve = _logistic(x, y, w)
    p = 1 / (1 + np.exp(-np.clip(model.probability(x), -30, 30)))
    return float(-np.average(y * np.log(p) + (1 - y) * np.log(1 - p), weights=w))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    spark = docs.sparkSession
    rows = labels.where("doc_id is not null and toxic is not null").where(fold() != 2).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = rows.count()
    share = min(1.0, train_rows / max(n, 1))
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).withColumn("part", fold())
    known = docs.join(F.broadcast(rows), "doc_id")  # about train_rows rows of 20 bytes
    held = F.col("part") == 3
    base = {(r["held"], r["toxic"]): r["n"] for r in known.groupBy(held.alias("held"), "toxic").agg(F.count("*").alias("n")).collect()}
    nt, nc = base.get((False, 1), 0), base.get((False, 0), 0)
    if not nt or not nc:
        return Model(np.empty(0, U64), np.empty(0))
    counted = known.where("part <> 3").select("toxic", "text").mapInArrow(_counter, "feature long, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    pt, pc = F.col("t") + PRIOR * nt / (nt + nc), F.col("c") + PRIOR * nc / (nt + nc)
    odds = F.log(pt / nt) - F.log(pc / nc)
    z = odds / F.sqrt(1 / pt + 1 / pc)
    # the last choice, each being narrower than the one before, that a feature passes
    choice = F.lit(-1)
    for g, (least_z, least_odds) in enumerate(GRID):
        choice = F.when((F.col("z") >= least_z) & (F.col("odds") >= least_odds), g).otherwise(choice)
    kept = counted.where(f"t >= {LEAST_TOXIC} and feature <> 0").select("feature", odds.alias("odds"), z.alias("z")).withColumn("choice", choice).where("choice >= 0").select("feature", "odds", "choice").toPandas()
    names, weights, passed = kept["feature"].to_numpy(np.int64).view(U64), np.minimum(kept["odds"].to_numpy(float), MOST_WEIGHT), kept["choice"].to_numpy()
    if not len(kept):
        return Model(names, weights)
    tops = known.where(held).select("toxic", "text").mapInArrow(_tops(spark.sparkContext.broadcast((names, weights, passed))), "toxic int, choice int, n_words int, top double")
    binned = tops.groupBy("choice", "toxic", F.round("top", 1).alias("top"), F.round(F.log(F.greatest("n_words", F.lit(1))), 1).alias("ln")).agg(F.count("*").alias("w")).toPandas()
    models = []
    for g in range(len(GRID)):
        model = Model(names[passed >= g], weights[passed >= g])
        rows_g = binned[binned["choice"] == g]
        models.append((calibrate(model, rows_g) if len(rows_g) else 0.0, -g, model))
    return min(models, key=lambda m: m[:2])[2]


def score_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = 0.3) -> DataFrame:
    """Columns doc_id, held_out, score, predicted, segments (first word, words, score of each maximal segment)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(docs, labels, train_rows)
    out = docs.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model)), RESULT)
    score = 1 / (1 + F.exp(-(F.lit(model.curve[0]) + F.lit(model.curve[1]) * F.col("evidence"))))
    out = out.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), score.alias("score"), "segments")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "segments")
