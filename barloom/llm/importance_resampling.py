"""Importance resampling of documents towards a target set, by hashed n-gram features.

Features by overlapped regex scanning: a text's A-Z become a-z, all between words becomes one space, and for each length a pattern with
lookarounds at word boundaries is run with ``overlapped=True``, so every span of so many words is a match. The spans' bytes go to CRC-32, whose
remainder names a bucket.

Weights: all documents hold S features, s in a bucket, all target texts T and t; a bucket's gain is
``floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))``, a document's weight the floored mean over its features. The score adds Gumbel noise
from ``sha256("<seed>:<doc_id>")``, so the highest scores are a draw without replacement in proportion to exp(weight / 1000), and reruns agree.

The draw: of N documents with at least ``least_words`` words, the ``floor(percent * N / 100)`` highest scores, ties to the smaller doc_id.
Scores' frequencies (in steps of 16; there are as many steps as the logarithm of the counts allows, some thousands) tell which can be drawn; only those are
put in a global order, over as many partitions as they need.

Defined results: null and wordless texts have no features and weight 0; a null doc_id has no digits and comes after others in ties; repeated doc_ids are rows of
their own (ties: larger weight, then more features first); without target texts all T and t are 0; no other columns are read.

What is scanned leaves as one row of (bucket, count) for each document, written once: texts are scanned once. Bucket totals are summed in tasks before
they are shuffled. The driver gets one number for each bucket and each step of scores, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import LOWER, Scratch, chunks, text_arrays

#: Maps A-Z to a-z and every byte that is not of a word to a space.
FLAT = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in LOWER.tolist())
#: Scores are counted in steps of this size before the draw.
STEP = 16
_span = type(regex.match(b"", b"")).span


def span_pattern(n: int) -> regex.Pattern:
    """Every run of n words in a text whose words stand one space apart, if matches may overlap."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def flattened(text: bytes) -> bytes:
    """The words with single spaces between them."""
    return b" ".join(text.translate(FLAT).split())


def features(flat: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of each feature of a flattened text."""
    view, crc = memoryview(flat), zlib.crc32
    return np.concatenate([np.fromiter((crc(view[a:b]) for a, b in map(_span, p.finditer(flat, overlapped=True))), np.int64) for p in patterns]) % buckets


def _scan(batches: Iterator[pa.RecordBatch], lengths: tuple[int, int], buckets: int) -> Iterator[pa.RecordBatch]:
    patterns = [span_pattern(n) for n in range(lengths[0], lengths[1] + 1)]
    for batch in batches:
        for part in chunks(batch, at=2):
            data, offsets = text_arrays(part.column(2))
            words, sizes, names, counts = [], [], [], []
            for i in range(part.num_rows):
                flat = flattened(data[offsets[i] : offsets[i + 1]].tobytes())
                got = features(flat, patterns, buckets)
                n, c = np.unique(got, return_counts=True)
                words.append(flat.count(b" ") + 1 if flat else 0)
                sizes.append(len(got))
                names.append(n)
                counts.append(c)
            ends = np.concatenate([[0], np.cumsum([len(n) for n in names])]).astype(np.int32)
            held = pa.StructArray.from_arrays([pa.array(np.concatenate(names).astype(np.int32)), pa.array(np.concatenate(counts).astype(np.int64))], ["bucket", "n"])
            columns = [part.column(0), part.column(1), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), held)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_words", "n_features", "features"])


def scanned(docs: DataFrame, lengths: tuple[int, int] = (1, 1), buckets: int = 10_000) -> DataFrame:
    """doc_id, text_key, n_words, n_features and features, an array of (bucket, n), of each row."""
    doc_id = F.col("doc_id").cast("long") if "doc_id" in docs.columns else F.lit(None).cast("long")
    text = F.col("text").cast("string")
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(lambda b: _scan(b, lengths, buckets), "doc_id long, text_key long, n_words long, n_features long, features array<struct<bucket:int,n:long>>")


def bucket_totals(scans: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket has; one row for each bucket comes to the driver."""
    out = np.zeros(buckets, np.int64)
    for r in scans.select(F.inline("features")).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    S, T, k = float(corpus.sum()), float(target.sum()), float(len(corpus))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (S + k) / ((s + 1.0) * (T + k)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scores(batches: Iterator[pa.RecordBatch], gains: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.asarray(batch.column(3))
        held = batch.column(4)
        lengths = np.diff(np.asarray(held.offsets))
        flat = held.flatten()
        each = gains[np.asarray(flat.field(0))] * np.asarray(flat.field(1))
        total = np.concatenate([[0], np.cumsum(each)])
        ends = np.cumsum(lengths)
        weight = (total[ends] - total[ends - lengths]) // np.maximum(sizes, 1)
        score = weight + np.array([noise(d, seed) for d in batch.column(0).to_pylist()], np.int64)
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(weight), pa.array(score)], ["doc_id", "text_key", "n_words", "n_features", "weight", "score"])


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, lengths: tuple[int, int] = (1, 1), buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """doc_id, text_key, n_words, n_features, weight, score and rank (1, 2, 3, ... of those drawn; else null) of each row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    scans = scratch.keep(scanned(docs, lengths, buckets), "features")
    gains = bucket_gains(bucket_totals(scans, buckets), bucket_totals(scanned(target.select("text"), lengths, buckets), buckets))
    scored = scratch.keep(scans.mapInArrow(lambda b: _scores(b, gains, seed), "doc_id long, text_key long, n_words long, n_features long, weight long, score long"), "scored")
    scratch.drop("features")

    able = F.col("n_words") >= least_words
    steps = scored.where(able).groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(F.count("*").alias("n")).collect()
    draw = sum(r.n for r in steps) * percent // 100
    least, above = None, 0
    for r in sorted(steps, key=lambda r: -r.step):
        if above >= draw:
            break
        least, above = r.step * STEP, above + r.n
    none = F.lit(None).cast("long")
    if least is None:
        return scored.withColumn("rank", none)
    near = able & (F.col("score") >= least)
    first = numbered(scored.where(near), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc(), "text_key")
    first = first.withColumn("rank", F.when(F.col("place") < draw, F.col("place") + 1)).drop("place")
    return scored.where(~near).withColumn("rank", none).unionByName(first)


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, columns as given; rows equal in doc_id and text are drawn together."""
    d = resampled(docs, target, **options).where("rank is not null").select(F.col("doc_id").alias("_drawn_id"), F.col("text_key").alias("_drawn_key")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("key"))
    return rows.join(d, F.col("id").eqNullSafe(F.col("_drawn_id")) & (F.col("key") == F.col("_drawn_key")), "left_semi").select("row.*")
