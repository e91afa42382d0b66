"""Fill-in-middle transformation of whole documents by piece tables.

A document is a list of pieces, (buffer, begin, end) over two buffers that never change: its own UTF-8 bytes, and the bytes of the three marks.
Cutting splits a piece in two without moving text; an arrangement permutes the three pieces and puts marks between them;
digests read the pieces one after the other. The inverse finds the marks in an output, which leaves three pieces of that output, and permutes
them back.

The cuts and the form come from ``sha256("<seed>:<doc_id>")``: its first four groups of 8 hex digits are h1 to h4. With n code points the prefix
ends after the smaller of ``h1 % (n + 1)`` and ``h2 % (n + 1)``, the middle after the larger. A text stays plain if it is empty, has one of the
marks or ``h3 % 100 >= plain_from``; else it is spm if ``h4 % 100 < spm_below`` and psm otherwise.

Defined results: null text is empty; a null doc_id has no digits (``"<seed>:"``); equal rows are cut alike; pieces may be empty; other columns, whatever
their names, are not read. A text never meets another one, so no group of copies can grow in a task; a text's positions are counted block by
block, so nothing is held of it but its bytes and its output's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, text_arrays

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The buffer of marks, and which of its bytes each mark is.
MARKS = PREFIX + SUFFIX + MIDDLE
MARK_AT = {PREFIX: (0, 3), SUFFIX: (3, 6), MIDDLE: (6, 9)}
#: Which part follows which mark in an output.
ARRANGEMENTS = {"psm": ((PREFIX, "prefix"), (SUFFIX, "suffix"), (MIDDLE, "middle")), "spm": ((SUFFIX, "suffix"), (PREFIX, "prefix"), (MIDDLE, "middle"))}
ORDER = ("prefix", "middle", "suffix")
TEXT, MARK = 0, 1
BLOCK = 1 << 20

Piece = tuple[int, int, int]


def code_points(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero((data[a : a + BLOCK] & 0xC0) != 0x80)) for a in range(0, len(data), BLOCK))


def byte_at(data: np.ndarray, point: int) -> int:
    """Where the code point with this number begins; the end, if there are no more."""
    for a in range(0, len(data), BLOCK):
        leads = np.flatnonzero((data[a : a + BLOCK] & 0xC0) != 0x80)
        if point < len(leads):
            return a + int(leads[point])
        point -= len(leads)
    return len(data)


def cut(pieces: list[Piece], at: int) -> list[Piece]:
    """The pieces with the one that holds place ``at`` split there; the last one that reaches it is split, so one more piece always results."""
    out, done = list(pieces), 0
    for i, (buffer, begin, end) in enumerate(pieces):
        if at <= done + end - begin and (i == len(pieces) - 1 or at < done + end - begin):
            middle = begin + at - done
            return [*out[:i], (buffer, begin, middle), (buffer, middle, end), *out[i + 1 :]]
        done += end - begin
    raise ValueError("a cut beyond the end")


def arranged(parts: dict[str, Piece], form: str) -> list[Piece]:
    return [x for mark, name in ARRANGEMENTS[form] for x in ((MARK, *MARK_AT[mark]), parts[name])]


def restored(output: bytes, form: str) -> list[Piece]:
    """The pieces of an output, with itself as the text's buffer, that are the document."""
    if form == "plain":
        return [(TEXT, 0, len(output))]
    at, begins = 0, []
    for mark, _ in ARRANGEMENTS[form]:  # no text with a mark is arranged, so the next one is the one put there
        at = output.index(mark, at)
        begins.append((at, at + len(mark)))
        at += len(mark)
    ends = [b for b, _ in begins[1:]] + [len(output)]
    parts = {name: (TEXT, b[1], e) for (_, name), b, e in zip(ARRANGEMENTS[form], begins, ends, strict=True)}
    return [parts[name] for name in ORDER]


def spelled(pieces: list[Piece], text: memoryview) -> bytes:
    buffers = (text, memoryview(MARKS))
    return b"".join(buffers[b][x:y] for b, x, y in pieces)


def digest(pieces: list[Piece], text: memoryview) -> str:
    buffers, h = (text, memoryview(MARKS)), hashlib.sha256()
    for b, x, y in pieces:
        h.update(buffers[b][x:y])
    return h.hexdigest()


def pieces_of(data: np.ndarray, text: memoryview, doc_id: int | None, seed: int, plain_from: int, spm_below: int) -> tuple[int, str, int | None, int | None, list[Piece]]:
    """n, form, prefix_chars, middle_chars and the output's pieces of one document."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n, whole = code_points(data), (TEXT, 0, len(data))
    raw = text.obj if isinstance(text.obj, bytes) else bytes(text)
    if not n or h3 % 100 >= plain_from or any(m in raw for m in MARK_AT):
        return n, "plain", None, None, [whole]
    form = "spm" if h4 % 100 < spm_below else "psm"
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    first = byte_at(data, a)
    second = first + byte_at(data[first:], b - a)
    prefix, rest = cut([whole], first)
    middle, suffix = cut([rest], second - first)
    return n, form, a, b - a, arranged({"prefix": prefix, "middle": middle, "suffix": suffix}, form)


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def _rows(batches: Iterator[pa.RecordBatch], seed: int, plain_from: int, spm_below: int, texts: bool) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = [pa.int64() if x.split()[1] == "long" else pa.string() for x in SCHEMA.split(", ")]
    for batch in batches:
        for part in chunks(batch):
            data, offsets = text_arrays(part.column(1))
            rows, outputs = [], []
            for i, doc_id in enumerate(part.column(0).to_pylist()):
                own = data[offsets[i] : offsets[i + 1]]
                text = memoryview(own.tobytes())
                n, form, p, m, pieces = pieces_of(own, text, doc_id, seed, plain_from, spm_below)
                output = spelled(pieces, text)
                rows.append((doc_id, n, form, p, m, digest(pieces, text), digest(restored(output, form), memoryview(output))))
                if texts:
                    outputs.append(output)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            if texts:
                columns.append(pa.array(outputs, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names + ["output"] * texts)


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, texts: bool = True) -> DataFrame:
    """doc_id, n, form, prefix_chars and middle_chars (null if plain), digests of the output and of what is restored from it, and the output itself.

    ``texts``: without it the outputs are spelled and restored in the tasks all the same, but only their digests leave them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _rows(b, seed, plain_from, spm_below, texts), SCHEMA + ", output string" * texts)


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, at=2):
            data, offsets = text_arrays(part.column(2))
            texts = []
            for i, form in enumerate(part.column(1).to_pylist()):
                output = data[offsets[i] : offsets[i + 1]].tobytes()
                texts.append(spelled(restored(output, form or "plain"), memoryview(output)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id and text of rows with doc_id, form and output, as ``fill_in_middle`` gives them; a null output is an empty text."""
    rows = outputs.select(F.col("doc_id").cast("long").alias("doc_id"), "form", "output")
    return rows.mapInArrow(_back, "doc_id long, text string")
