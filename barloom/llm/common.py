"""Helpers that the corpus operators share: scratch tables, byte-level word hashing, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.entities import connected

U64 = np.uint64
#: Bytes of text that are held as numpy arrays at a time in a task.
CHUNK_BYTES = 2_000_000


# ---------------------------------------------------------------- scratch tables


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Only where the session has none, as in local tests, one under the warehouse folder is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Spark's settings while a scratch table is written: drop the execution's shuffle files at once rather than at some later garbage
#: collection, and send texts to Python workers in smaller batches, of which two sides hold a copy each.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result once to the shared folder and read it back, which also cuts lineage."""
    return _written(df, name)[0]


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The write's own shuffle files go as soon as it has ended; nothing executes ``df`` again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path), path


class Scratch:
    """Scratch tables of one run by name, each dropped once nothing reads it any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df, self.paths[name] = _written(df, name)
        return df

    def drop(self, *names: str) -> None:
        """Leave empty tables in their place, which also works in stores that only Spark reaches."""
        for name in names:
            self.spark.createDataFrame([], "dropped int").write.mode("overwrite").parquet(self.paths.pop(name))


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name = "_" + name
    return name


# ---------------------------------------------------------------- bytes of texts


def text_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each text starts (one more at the end)."""
    texts = pa.array(texts, pa.large_binary()) if not isinstance(texts, (pa.Array, pa.ChunkedArray)) else texts
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.cast(pa.large_string()).fill_null("") if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else texts.fill_null(b"")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.empty(0, np.uint8)
    return buf, offsets - (offsets[0] if len(offsets) else 0)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES, at: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text; a longer text is a slice of its own. ``at``: the column's place, instead of its name."""
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column) if at is None else at)
    sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
    group = np.cumsum(sizes) // limit
    alone = sizes > limit
    new = (np.diff(group) > 0) | alone[1:] | alone[:-1]
    edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(sizes)]])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(int(a), int(b - a))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


def class_table(chars: bytes) -> np.ndarray:
    """Which byte values separate words."""
    out = np.ones(256, dtype=bool)
    out[list(chars)] = False
    return out


#: Words ``[^\x20\x09-\x0D]+``: all but the six ASCII space characters.
SPACED = class_table(bytes([0x20, *range(0x09, 0x0E)]))
#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def word_spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word and how many words each text has."""
    m = is_word[buf]
    begins, ends = m.copy(), m.copy()
    begins[1:] &= ~m[:-1]
    ends[:-1] &= ~m[1:]
    first = offsets[:-1][(offsets[:-1] < len(buf)) & (np.diff(offsets) > 0)]
    begins[first] = m[first]
    last = first[first > 0] - 1
    ends[last] = m[last]
    s = np.flatnonzero(begins)
    e = np.flatnonzero(ends) + 1
    return s, e, np.diff(np.searchsorted(s, offsets))


def word_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of the bytes of every word: a polynomial over random byte values, scrambled."""
    if not len(s):
        return np.empty(0, U64)
    table = _byte_table(seed)
    lengths = e - s
    total = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(total[-1]) - np.repeat(total[:-1], lengths)
    powers = np.full(int(lengths.max()), U64(0xD1342543DE82EF95), dtype=U64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    values = table[buf[at + np.repeat(s, lengths)]] * powers[at]
    return mix(np.add.reduceat(values, total[:-1]) + lengths.astype(U64) * U64(0x9E3779B97F4A7C15))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive values, by doubling; one for each start that has k."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    out, done, power, step = None, 0, h, 1
    while True:
        if k & step:
            part = power[done : done + n]
            out = part if out is None else mix(out * U64(0xA24BAED4963EE407) + part)
            done += step
        if done == k:
            return mix(out + U64(k))
        power = mix(power[: len(power) - step] * U64(0x9FB21C651E98DF25) + power[step:])
        step *= 2


# ---------------------------------------------------------------- connected components


def components(nodes: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    """The nodes with component_id, the smallest key reachable over ``edges`` (a, b); nodes without edges are their own."""
    shared_dir(nodes.sparkSession)
    label = connected(edges.select("a", "b").where("a <> b"))
    return nodes.join(label, nodes[key] == label["node"], "left").select(nodes["*"], F.coalesce("component", key).alias("component_id"))
