"""Token counts with a digest cache.

The cache is a Parquet table (digest of the normalised content, number of tokens) below a folder named by the
digest of the tokenizer: its vocabulary file, the library's version and the normaliser's. A run joins the digests of all
texts with it, encodes each distinct missing content once, appends those counts and joins again.

The byte-level tokenizers keep every byte, so the normaliser here only turns null into the empty text; its
name is part of the tokenizer digest, so that a coarser one would get a cache of its own.

Defined results: null and empty texts have 0 tokens; repeated rows give one row each; other columns are
ignored. A run that fails leaves at most complete counts in the cache; counts appended twice are merged on reading.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, materialize, shared_dir

NORMALISER = "null-as-empty/1"
CACHE_SCHEMA = "digest binary, n_tokens long"
#: Entries of the per-worker memo of encoded pieces; it is emptied when full.
MEMO = 300_000
#: A space between two other white spaces: splitting there could change the tokens.
UNSAFE = re.compile(r"\s \s")

_state: dict = {}


def vocabulary(name: str) -> str:
    """The place of a vocabulary file: a path as it is, a bare name among the installed ones."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_digest(name: str) -> str:
    import tokenizers

    return hashlib.sha256(Path(vocabulary(name)).read_bytes() + f"\0{NORMALISER}\0{tokenizers.__version__}".encode()).hexdigest()


def slow_tokenizer(name: str):
    """The tokenizers library's tokenizer of this worker, loaded once."""
    if _state.get("name") != name:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(vocabulary(name))
        t.no_truncation()
        t.no_padding()
        _state.update(name=name, tokenizer=t, memo={})
    return _state["tokenizer"]


def byte_level(t) -> bool:
    """Whether the file is plain byte-level BPE, which never joins across the spaces that begin pieces."""
    return type(t.model).__name__ == "BPE" and type(t.pre_tokenizer).__name__ == "ByteLevel" and t.normalizer is None


def text_lengths(texts: list[str], name: str) -> list[int]:
    """Tokens of each text. A text is cut before spaces that begin a piece, where byte-level BPE never joins; equal pieces are encoded once."""
    t = slow_tokenizer(name)
    if not byte_level(t):
        return [len(x) for x in t.encode_batch_fast(texts, add_special_tokens=False)]
    memo = _state["memo"]
    split = [None if UNSAFE.search(x) else x.split(" ") for x in texts]
    need: set[str] = set()
    for x in split:
        if x:
            need.update(x[1:])
    need.difference_update(memo)
    if len(memo) + len(need) > MEMO:
        need.update(p for x in split if x for p in x[1:])
        memo.clear()
    if need:
        missing = list(need)
        memo.update(zip(missing, map(len, t.encode_batch_fast([" " + p for p in missing], add_special_tokens=False)), strict=True))
    heads = t.encode_batch_fast([x[0] if x else w for x, w in zip(split, texts, strict=True)], add_special_tokens=False)
    return [len(h) + (sum(map(memo.__getitem__, x[1:])) if x else 0) for h, x in zip(heads, split, strict=True)]


def _encoder(name: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                n = text_lengths(part.column(1).to_pylist(), name)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return encode


def _cached(spark: SparkSession, path: str, own: DataFrame) -> DataFrame | None:
    """Stored counts of the digests ``own``; what else the cache has is read past, but neither grouped nor written."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return None
    return rows.join(own, "digest", "left_semi").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", cache: str | None = None, limit: int = 1024) -> DataFrame:
    """Columns doc_id, n_bytes, n_tokens, over_limit. ``cache``: a folder; None takes a new one in the shared folder."""
    spark = docs.sparkSession
    path = f"{cache or f'{shared_dir(spark)}/token-cache-{uuid.uuid4().hex}'}/tokenizer={tokenizer_digest(tokenizer)}"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id"), text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    ids = materialize(keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "digests")
    own = ids.select("digest").distinct()
    stored = _cached(spark, path, own)
    missing = keyed if stored is None else keyed.join(stored, "digest", "left_anti")
    missing = missing.groupBy("digest").agg(F.first("text").alias("text"))
    missing.mapInArrow(_encoder(tokenizer), CACHE_SCHEMA).write.mode("append").parquet(path)
    stored = materialize(_cached(spark, path, own), "token-counts")  # apart from the join, so that Spark can split a very common content there
    return ids.join(stored, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
