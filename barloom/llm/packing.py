"""Packing of token sequences with a bounded number of open windows.

Each partition encodes its documents (ids, then an end id), sends whole windows out at once and places what
is left of each document best-fit into at most ``open_windows`` open windows. When none fits, the fullest
one is filled with the beginning of the piece and emitted, and the rest opens a window. What is
open at a partition's end goes, with its ids, to a second and much smaller round that does the same
over many partitions' leftovers; its own last windows are run together, and the very last one is cut
to powers of two, which need no padding.

Ids come from a faster library with the same vocabulary, save for texts with very long runs of one kind of character, which
it cannot take; both give the same ids.

Defined results: null and empty texts are the end id alone; every row is a document of its own, also repeated
ones; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialize
from .token_counts import byte_level, slow_tokenizer, vocabulary

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Leftover pieces that one task of the second round takes.
LEFT_PER_TASK = 20_000

#: The faster encoder fails on runs of some 1,000,000 characters of one kind; texts with shorter ones than that already go to the slower library.
LONG_RUN = 50_000
RUN = re.compile(r"\s{%d}|[^\W\d_]{%d}|\d{%d}|(?:[^\w\s]|_){%d}" % ((LONG_RUN,) * 4))

_state: dict = {}


def token_ids(text: str, name: str) -> list[int]:
    """The ids of a whole text, as the tokenizers library gives them."""
    if not byte_level(slow_tokenizer(name)) or (len(text) >= LONG_RUN and RUN.search(text)):
        return slow_tokenizer(name).encode(text, add_special_tokens=False).ids
    enc = _encoding(name)
    return enc.encode(text, allowed_special="all") if any(x in text for x in enc.special_tokens_set) else enc.encode_ordinary(text)


def _encoding(name: str):
    """The encoder of this worker: the vocabulary of a byte-level BPE file as ranks, with the file's own special tokens."""
    if _state.get("name") != name:
        import json

        import public_tokenizers
        import tiktoken

        with open(vocabulary(name), encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        plain = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(plain[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _state.update(name=name, encoding=tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special))
    return _state["encoding"]


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Windows:
    """Open windows of a partition; pieces are (doc_id, start, doc_tokens, ids)."""

    def __init__(self, size: int, most: int, first_id: int):
        self.size, self.most, self.next = size, most, first_id
        self.open: list[tuple[int, int, list]] = []  # (gap, age, pieces), sorted
        self.age = 0
        self.out: list[tuple] = []

    def emit(self, pieces: list) -> None:
        at = 0
        for doc, start, total, ids in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids), total, self.next, at, None))
            at += len(ids)
        self.next += 1

    def add(self, doc, start: int, total: int, ids: np.ndarray) -> None:
        while len(ids) >= self.size:
            self.emit([(doc, start, total, ids[: self.size])])
            start, ids = start + self.size, ids[self.size :]
        if len(ids):
            self.place((doc, start, total, ids))

    def place(self, piece: tuple) -> None:
        doc, start, total, ids = piece
        i = bisect.bisect_left(self.open, (len(ids), -1))
        if i < len(self.open):  # the smallest gap that takes it
            gap, _, pieces = self.open.pop(i)
            pieces.append(piece)
            self.keep(gap - len(ids), pieces)
        elif len(self.open) < self.most:
            self.keep(self.size - len(ids), [piece])
        else:
            gap, _, pieces = self.open.pop(0)
            pieces.append((doc, start, total, ids[:gap]))
            self.emit(pieces)
            self.keep(self.size - (len(ids) - gap), [(doc, start + gap, total, ids[gap:])])

    def keep(self, gap: int, pieces: list) -> None:
        if not gap:
            self.emit(pieces)
            return
        self.age += 1
        bisect.insort(self.open, (gap, self.age, pieces))

    def left(self) -> None:
        """Hand the open windows' pieces on, with their ids."""
        for _, _, pieces in self.open:
            self.out += [(doc, start, len(ids), zlib.crc32(ids), total, None, None, ids.tobytes()) for doc, start, total, ids in pieces]
        self.open = []

    def close(self) -> None:
        """Run the open windows together; only the last sequence is short, in powers of two."""
        row = [p for w in self.open for p in w[2]]
        self.open = []
        rest = sum(len(p[3]) for p in row)
        size = self.size
        while rest:
            while size > rest:
                size //= 2
            pieces, need = [], size
            while need:
                doc, start, total, ids = row.pop(0)
                if len(ids) > need:
                    row.insert(0, (doc, start + need, total, ids[need:]))
                    ids = ids[:need]
                pieces.append((doc, start, total, ids))
                need -= len(ids)
            self.emit(pieces)
            rest -= size

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.out) >= least:
            kinds = [pa.int64()] * 7 + [pa.binary()]
            names = [c.split()[0] for c in PIECE.split(", ")]
            out, self.out = self.out, []
            for at in range(0, len(out), 20_000):
                cols = zip(*out[at : at + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def _first_round(tokenizer: str, size: int, most: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Windows(size, most, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for part in chunks(batch):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = token_ids(text or "", tokenizer)
                    ids.append(end)
                    w.add(doc, 0, len(ids), np.array(ids, dtype="<u4"))
                yield from w.batches(20_000)
        w.left()
        yield from w.batches(1)

    return run


def _second_round(size: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Windows(size, most, 1 << 61 | TaskContext.get().partitionId() << 32)
        for batch in batches:
            for r in batch.to_pylist():
                w.add(r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4"))
            yield from w.batches(20_000)
        w.close()
        yield from w.batches(1)

    return run


def pack(docs: DataFrame, size: int = 1024, tokenizer: str = "byte_bpe_50k.json", open_windows: int = 32, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``size`` is a power of two."""
    if size & (size - 1):
        raise ValueError("size is not a power of two")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = materialize(docs.mapInArrow(_first_round(tokenizer, size, open_windows, end_id), PIECE), "pieces")
    left = first.where("sequence_id is null")
    tasks = max(1, left.count() // LEFT_PER_TASK)
    # longest first, so that short pieces fill what is left; the order also makes reruns agree
    dealt = left.repartition(tasks, F.xxhash64("doc_id", "start")).sortWithinPartitions(F.desc("length"), "doc_id", "start", "ids_crc32")
    second = dealt.mapInArrow(_second_round(size, open_windows), PIECE)
    return first.where("sequence_id is not null").unionByName(second).drop("ids")
