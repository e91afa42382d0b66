"""Exact removal of repeated word windows, found by recompression.

A window is ``width`` consecutive words of one document. A word goes if a window that covers it also
starts in a document with a smaller doc_id; windows are judged on the input.

*Recompression.* Every text is a string of word names. Rounds replace runs of one name, and pairs whose
left name falls in the left half and right name in the right half of that round's alphabet, by new names. A
new name is a 64-bit digest of what it replaces, so all tasks of all rounds give equal substrings the same
name without exchanging a dictionary, save near a substring's ends. Each symbol carries the
interval of words that its being there depends on; if that interval lies in a window, every occurrence
of the window has the symbol. Spark counts the high-level symbols of all distinct texts:

* a text's top symbol (the digest of all its words) shows whole copies: every window of a later copy is repeated;
* a window with a symbol that only one distinct text has cannot be repeated and is dropped;
* the other windows are verified: joined on 128 bits of their own words.

Symbols only drop windows that cannot repeat, so the result is exact.

Defined results: null and wordless texts have no words and the digest of the empty string; a null doc_id
is no source and loses nothing; rows with equal doc_id are not smaller than each other, each has a result of its own;
a window that repeats within its own document only stays; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, U64, Scratch, chunks, mix, text_arrays, window_hashes, word_hashes, word_spans

#: Rounds, in order: r renames runs, p renames pairs.
ROUNDS = "rppppppp"
#: No symbol covers more words than this, so that several fit in a window.
LONGEST = 16
FAR = 1 << 40
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

PARSED = "doc_id long, text_key long, n_words long, sha string, symbols array<long>"
WINDOWS = "doc_id long, sha string, text string, at array<int>, k1 array<long>, k2 array<long>"


def usable(p: "Symbols", counts: np.ndarray, width: int) -> np.ndarray:
    """Symbols that stand, with all they depend on, in at least one window of their text."""
    end = np.cumsum(counts)[p.doc]
    return (p.hi - p.lo <= width) & (p.lo >= end - counts[p.doc]) & (p.hi <= end) & (counts[p.doc] >= width)


class Symbols:
    """Symbols of many texts end to end: name, words [start, end), text, and the words [lo, hi) they depend on."""

    def __init__(self, h: np.ndarray, counts: np.ndarray):
        n = len(h)
        self.name, self.doc = h, np.repeat(np.arange(len(counts)), counts)
        self.start, self.end = np.arange(n), np.arange(1, n + 1)
        self.lo, self.hi = self.start.copy(), self.end.copy()

    def _depend(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """lo and hi, widened by the left or right neighbour where asked; a text's edge counts as far away."""
        lo, hi, same = self.lo.copy(), self.hi.copy(), self.doc[1:] == self.doc[:-1]
        plo, phi = np.full(len(lo), -FAR), np.full(len(lo), -FAR)
        plo[1:], phi[1:] = np.where(same, self.lo[:-1], -FAR), np.where(same, self.hi[:-1], -FAR)
        nlo, nhi = np.full(len(lo), FAR), np.full(len(lo), FAR)
        nlo[:-1], nhi[:-1] = np.where(same, self.lo[1:], FAR), np.where(same, self.hi[1:], FAR)
        lo = np.where(left, np.minimum(lo, plo), lo)
        hi = np.where(left, np.maximum(hi, phi), hi)
        return np.where(right, np.minimum(lo, nlo), lo), np.where(right, np.maximum(hi, nhi), hi)

    def _take(self, at: np.ndarray, name: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """Join the symbols from each index in ``at`` up to the next one."""
        stop = np.append(at[1:], len(self.name)) - 1
        self.lo, self.hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
        self.name, self.start, self.end, self.doc = name, self.start[at], self.end[stop], self.doc[at]

    def pairs(self, seed: int) -> None:
        if len(self.name) < 2:
            return
        left = (mix(self.name ^ U64(seed)) >> U64(63)) == 0
        size = self.end - self.start
        join = np.zeros(len(left), bool)
        join[:-1] = left[:-1] & ~left[1:] & (self.doc[1:] == self.doc[:-1]) & (size[1:] + size[:-1] <= LONGEST)
        second = np.zeros(len(left), bool)
        second[1:] = join[:-1]
        alone = ~join & ~second
        lo, hi = self._depend(alone & ~left, alone & left)
        name = self.name.copy()
        j = np.flatnonzero(join)
        name[j] = mix(mix(name[j] + U64(seed)) * U64(0x9FB21C651E98DF25) + name[j + 1])
        at = np.flatnonzero(~second)
        self._take(at, name[at], lo, hi)

    def runs(self) -> None:
        if len(self.name) < 2:
            return
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        every = np.ones(len(new), bool)
        lo, hi = self._depend(every, every)
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        lo, hi = np.minimum.reduceat(lo, first)[run], np.maximum.reduceat(hi, first)[run]
        times = np.diff(np.append(first, len(new)))
        words = self.end[np.append(first[1:], len(new)) - 1] - self.start[first]
        # that a run is too long shows within LONGEST words of any of its symbols
        wide = (words > LONGEST)[run]
        lo = np.where(wide, np.maximum(lo, self.start - LONGEST - np.maximum.reduceat(self.start - self.lo, first)[run]), lo)
        hi = np.where(wide, np.minimum(hi, self.end + LONGEST + np.maximum.reduceat(self.hi - self.end, first)[run]), hi)
        at = np.flatnonzero(new | ((times > 1) & (words > LONGEST))[run])  # longer runs stay apart
        name = self.name[at]
        whole = ((times > 1) & (words <= LONGEST))[run[at]]
        name = np.where(whole, mix(name * U64(0xA24BAED4963EE407) + times[run[at]].astype(U64)), name)
        self._take(at, name, lo, hi)


def recompress(h: np.ndarray, counts: np.ndarray) -> Symbols:
    out = Symbols(h, counts)
    for i, kind in enumerate(ROUNDS):
        out.runs() if kind == "r" else out.pairs(0x2545F4914F6CDD1D * (i + 1) & (2**64 - 1))
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(flat, kind))


def _parser(width: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                buf, offsets = text_arrays(part.column(1))
                s, e, counts = word_spans(buf, offsets, SPACED)
                p = recompress(word_hashes(buf, s, e), counts)
                use = usable(p, counts, width)
                doc, name = p.doc[use], p.name[use]
                order = np.lexsort((name, doc))
                doc, name = doc[order], name[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])
                raw = buf.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                symbols = _lists(_signed(name[new]), np.bincount(doc[new], minlength=len(counts)), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(counts.astype(np.int64)), pa.array(sha), symbols], ["doc_id", "text_key", "n_words", "sha", "symbols"])

    return parse


def _candidates(width: int):
    """Of each distinct text the windows all of whose own symbols other texts have too."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                buf, offsets = text_arrays(part.column(1))
                s, e, counts = word_spans(buf, offsets, SPACED)
                if not len(s):
                    continue
                h = word_hashes(buf, s, e)
                p = recompress(h, counts)
                lists = part.column(3)
                known = lists.flatten().to_numpy(zero_copy_only=False).view(U64)
                owner = np.repeat(np.arange(len(counts)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                use = usable(p, counts, width)
                names, docs, lo, hi = p.name[use], p.doc[use], p.lo[use], p.hi[use]
                shared = np.isin(mix(names) + docs.astype(U64), mix(known) + owner.astype(U64))
                alone = ~shared
                # windows [w, w + width) that hold [lo, hi): hi - width <= w <= lo
                first = np.concatenate([[0], np.cumsum(counts)])
                base = first[docs[alone]]
                a = np.maximum(hi[alone] - width, base)
                cover = np.bincount(a, minlength=len(h) + 1) - np.bincount(lo[alone] + 1, minlength=len(h) + 2)[: len(h) + 1]
                ok = np.cumsum(cover)[: len(h)] == 0
                place = np.arange(len(h)) - np.repeat(first[:-1], counts)
                ok &= place + width <= np.repeat(counts, counts)
                at = np.flatnonzero(ok)
                if not len(at):
                    continue
                k1, k2 = window_hashes(h, width)[at], window_hashes(word_hashes(buf, s, e, seed=2), width)[at]
                n = np.bincount(np.repeat(np.arange(len(counts)), counts)[at], minlength=len(counts))
                rows = pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(1), _lists(place[at].astype(np.int32), n, pa.int32()), _lists(_signed(k1), n, pa.int64()), _lists(_signed(k2), n, pa.int64())],
                    ["doc_id", "sha", "text", "at", "k1", "k2"],
                )
                yield rows.filter(pa.array(n > 0))

    return find


def _cutter(width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, text, sha = [], [], []
            for t, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = t.encode().split()
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, np.array(starts), 1)
                np.add.at(edge, np.array(starts) + width, -1)
                keep = np.cumsum(edge)[:-1] == 0
                kept = b" ".join([w for w, k in zip(words, keep, strict=True) if k])
                gone.append(len(words) - int(keep.sum()))
                text.append(kept.decode())
                sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(sha), pa.array(text)], ["doc_id", "sha", "gone", "kept_sha", "kept_text"])

    return cut


def repeated_words(docs: DataFrame, width: int = 50) -> DataFrame:
    """Columns doc_id, n_words, n_removed, kept_sha256, text_key (xxhash64 of the text), kept_text (null: nothing is removed; '': all is)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    tmp = Scratch(docs.sparkSession)
    parsed = tmp.keep(docs.mapInArrow(_parser(width), PARSED), "parsed")
    # written, as all that is joined with what may have one very common key, so that Spark can split that key there
    first = tmp.keep(parsed.where(f"n_words >= {width}").groupBy("sha").agg(F.min("doc_id").alias("first_id")), "first")

    # a distinct text is 128 bits of the digest of its words; a whole copy brings no new occurrence of its symbols
    who = [F.xxhash64("sha").alias("who"), F.xxhash64("sha", F.lit(1)).alias("who2")]
    held = parsed.select(*who, F.explode("symbols").alias("symbol"))
    shared = held.groupBy("symbol").agg(F.min("who").alias("lo"), F.max("who").alias("hi"), F.min("who2").alias("lo2"), F.max("who2").alias("hi2")).where("lo < hi or lo2 < hi2").select("symbol")
    shared = tmp.keep(shared, "shared")
    # written before the texts move, so that the symbols' shuffles are gone by then
    by_text = tmp.keep(held.join(shared, "symbol").groupBy("who", "who2").agg(F.collect_set("symbol").alias("symbols")), "shared-symbols")
    heads = tmp.keep(parsed.drop("symbols"), "heads")
    tmp.drop("parsed", "shared")
    mine = heads.where(f"n_words >= {width}").select("doc_id", "text_key", "sha", *who)
    mine = mine.join(first.withColumnRenamed("first_id", "doc_id"), ["sha", "doc_id"]).distinct().join(by_text, ["who", "who2"], "left")

    found = docs.join(mine.select("doc_id", "text_key", "sha", "symbols"), ["doc_id", "text_key"]).select("doc_id", "text", "sha", "symbols")
    found = tmp.keep(found.mapInArrow(_candidates(width), WINDOWS), "windows")
    tmp.drop("shared-symbols")
    one = found.select("doc_id", "sha", F.explode(F.arrays_zip("at", "k1", "k2")).alias("w")).select("doc_id", "sha", "w.at", "w.k1", "w.k2")
    source = one.groupBy("k1", "k2").agg(F.min("doc_id").alias("from_id"), F.max("doc_id").alias("to_id")).where("from_id < to_id").select("k1", "k2", "from_id")
    source = tmp.keep(source, "sources")
    hits = one.join(source, ["k1", "k2"]).where("doc_id > from_id").groupBy("doc_id", "sha").agg(F.collect_set("at").alias("starts"))
    cut = found.select("doc_id", "sha", "text").join(hits, ["doc_id", "sha"]).mapInArrow(_cutter(width), "doc_id long, sha string, gone long, kept_sha string, kept_text string")
    cut = tmp.keep(cut.dropDuplicates(["doc_id", "sha"]), "cut")
    tmp.drop("windows", "sources")

    out = heads.join(first, "sha", "left").join(cut, ["doc_id", "sha"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return out.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        "text_key",
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
