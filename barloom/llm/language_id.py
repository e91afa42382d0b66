"""Language of each document, and spans of one language, by a Viterbi path over its words.

A word is a run of letters a-z or non-ASCII characters; a run longer than ``LONGEST_WORD`` bytes counts as several.
The Unicode ranges of its characters name its script, and only the languages seen in that script are scored; the
others get a flat penalty. Each candidate's score is the log probability of the word's byte trigrams. The best path
through all words, with a penalty for each change of language, labels every word; the document's language is the one
with most words.

A task holds a bounded number of words at a time, fewer the more languages there are. Longer texts go in pieces: the
state is carried forward from piece to piece and kept at each border, from which the path is then read backwards.

Learned from rows of the given fold that have text and a language: about ``train_rows`` of them, and at least
``LEAST_ROWS`` of each language that has so many, drawn by a hash of doc_id for each language. The model is a table of
trigram buckets by language, so its size grows with the number of languages only.

Defined results: null, empty and letterless texts are ``und`` with score 0, and so is everything if there is nothing to
learn from; a language of which no row is drawn or has a word is not predicted; a null doc_id is not held out and not
learned from; repeated rows give one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import LOWER, chunks, class_table, fresh, text_arrays, word_spans

#: First code point of Unicode blocks by script; 0 stands for characters of no script.
SCRIPT_STARTS = {
    0x0000: 0, 0x0041: 1, 0x005B: 0, 0x0061: 1, 0x007B: 0, 0x00C0: 1, 0x02B0: 0, 0x0370: 2, 0x0400: 3, 0x0530: 4, 0x0590: 5,
    0x0600: 6, 0x0780: 0, 0x0900: 7, 0x0980: 8, 0x0A00: 9, 0x0A80: 10, 0x0B00: 0, 0x0B80: 11, 0x0C00: 12, 0x0C80: 13, 0x0D00: 14,
    0x0D80: 15, 0x0E00: 16, 0x0E80: 0, 0x10A0: 17, 0x1100: 18, 0x1200: 19, 0x1380: 0, 0x1E00: 1, 0x1F00: 2, 0x2000: 0,
    0x3040: 20, 0x3100: 0, 0x3400: 21, 0xA000: 0, 0xAC00: 18, 0xD7B0: 0,
}
SCRIPTS = 22
STARTS = np.array(list(SCRIPT_STARTS), dtype=np.int64)
STARTS_SCRIPT = np.array(list(SCRIPT_STARTS.values()), dtype=np.int64)

LETTERS = class_table(bytes([*range(0x61), *range(0x7B, 0x80)]))
BUCKETS = 1 << 16
TRAIN_ROWS, LEAST_ROWS = 20_000, 200
SWITCH_PENALTY = 8.0
OFF_SCRIPT = -30.0
#: Bytes of text that are held as arrays at a time, times four more than the number of languages.
HELD = 4_000_000
LONGEST_WORD = 1 << 14
#: Words of a text that the recursion takes one after the other; segments of a text run side by side.
SEGMENT = 256
#: Languages up to which their shares are broadcast; more are joined by shuffles.
MOST_BROADCAST = 10_000
RESULT = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,first_word:int,n_words:int>>"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def held_bytes(languages: int) -> int:
    """Bytes of text that a task turns into arrays at a time."""
    return max(LONGEST_WORD, HELD // (languages + 4))


def _cut_long(s: np.ndarray, e: np.ndarray, counts: np.ndarray, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with those of more than LONGEST_WORD bytes cut, at the beginnings of characters."""
    long = np.flatnonzero(e - s > LONGEST_WORD)
    if not len(long):
        return s, e, counts
    cuts = []
    for i in long.tolist():
        at = np.arange(s[i] + LONGEST_WORD, e[i], LONGEST_WORD)
        for _ in range(3):
            at = at - ((buf[at] & 0xC0) == 0x80)
        cuts.append(at[at > s[i]])
    more = np.array([len(c) for c in cuts])
    text = np.repeat(np.arange(len(counts)), counts)[long]
    flat = np.concatenate(cuts)
    return np.sort(np.concatenate([s, flat])), np.sort(np.concatenate([e, flat])), counts + np.bincount(text, weights=more, minlength=len(counts)).astype(counts.dtype)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text; the trigram bucket of every letter byte, where each word's begin, and each word's script."""
    raw, offsets = text_arrays(texts)
    buf = LOWER[raw]
    s, e, counts = _cut_long(*word_spans(buf, offsets, LETTERS), buf)
    if not len(s):
        return counts, np.empty(0, np.uint16), s, s
    length = e - s
    start = np.cumsum(length) - length
    letter = buf[np.repeat((s - start).astype(np.int32), length) + np.arange(length.sum(), dtype=np.int32)]
    before, after = np.roll(letter, 1), np.roll(letter, -1)
    before[start], after[start + length - 1] = 32, 32
    code = (before.astype(np.uint32) << 16) | (letter.astype(np.uint32) << 8) | after
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    # ASCII letters are Latin; other characters are looked up by code point where their first byte stands
    script = np.maximum.reduceat((letter < 0x80).astype(np.int8), start)
    wide = np.flatnonzero(letter >= 0xC0)
    if len(wide):
        b = letter[wide].astype(np.int64)
        n1 = letter[np.minimum(wide + 1, len(letter) - 1)].astype(np.int64) & 0x3F
        n2 = letter[np.minimum(wide + 2, len(letter) - 1)].astype(np.int64) & 0x3F
        point = np.where(b < 0xE0, ((b & 0x1F) << 6) | n1, np.where(b < 0xF0, ((b & 0x0F) << 12) | (n1 << 6) | n2, 0))
        of = np.searchsorted(start, wide, "right") - 1
        np.maximum.at(script, of, STARTS_SCRIPT[np.searchsorted(STARTS, point, "right") - 1].astype(np.int8))
    return counts, bucket, start, script


def _edges(raw: np.ndarray, limit: int) -> list[int]:
    """Where to cut a text's bytes into pieces of at most ``limit``: between words, or within a run too long for one word."""
    out = [0]
    while out[-1] < len(raw):
        to = min(len(raw), out[-1] + limit)
        if to < len(raw):
            gap = np.flatnonzero(~LETTERS[LOWER[raw[to - LONGEST_WORD : to]]])
            if len(gap):
                to += int(gap[-1]) + 1 - LONGEST_WORD
            while (raw[to] & 0xC0) == 0x80:
                to -= 1
        out.append(to)
    return out


def _pieces(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    raw = text_arrays(texts)[0]
    edges = _edges(raw, limit)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield pa.array([raw[a:b].tobytes()], pa.large_binary())


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) rows to trigram and script counts by language."""
    seen: dict[str, np.ndarray] = {}

    def add(texts: pa.Array, langs: np.ndarray) -> None:
        counts, bucket, start, script = _words(texts)
        if not len(start):
            return
        names, code = np.unique(langs.astype(str), return_inverse=True)
        word_lang = np.repeat(code, counts)
        byte_lang = np.repeat(word_lang, np.diff(np.append(start, len(bucket))))
        for i, name in enumerate(names):
            n = seen.setdefault(name, np.zeros(BUCKETS + SCRIPTS, np.int64))
            n[:BUCKETS] += np.bincount(bucket[byte_lang == i], minlength=BUCKETS)
            n[BUCKETS:] += np.bincount(script[word_lang == i], minlength=SCRIPTS)

    limit = held_bytes(4)
    for batch in batches:
        for part in chunks(batch, limit=limit):
            langs = np.asarray(part.column(0).to_pylist(), dtype=object)
            for texts in _pieces(part.column(1), limit) if part.num_rows == 1 else (part.column(1),):
                add(texts, langs)
    for name, n in seen.items():
        at = np.flatnonzero(n)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "slot", "n"])


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log probabilities [language, bucket], and which languages each script leaves [script, language]."""
    fold = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
    rows = fold.groupBy("lang").count()
    languages = rows.count()
    each = max(LEAST_ROWS, train_rows // max(languages, 1))
    share = rows.select("lang", (F.least(F.lit(1.0), F.lit(float(each)) / F.col("count")) * 1_000_000).alias("share"))
    drawn = fold.join(F.broadcast(share) if languages <= MOST_BROADCAST else share, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("share"))
    counted = drawn.select("lang", "text").mapInArrow(_counter, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    seen: dict[str, np.ndarray] = {}
    for r in counted.toLocalIterator():  # at most (buckets + scripts) x languages rows
        seen.setdefault(r["lang"], np.zeros(BUCKETS + SCRIPTS))[r["slot"]] = r["n"]
    langs = sorted(seen)
    if not langs:
        return [], np.empty((0, BUCKETS), np.float32), np.empty((SCRIPTS, 0), bool)
    logp = np.empty((len(langs), BUCKETS), np.float32)
    scripts = np.empty((SCRIPTS, len(langs)))
    for i, name in enumerate(langs):
        n = seen.pop(name)
        logp[i] = np.log((n[:BUCKETS] + 0.05) / (n[:BUCKETS] + 0.05).sum())
        scripts[:, i] = n[BUCKETS:]
    return langs, logp, scripts > 0.002 * np.maximum(scripts.sum(axis=0, keepdims=True), 1)


def word_scores(model: tuple, bucket: np.ndarray, start: np.ndarray, script: np.ndarray) -> np.ndarray:
    """[word, language]: log probability below that of the word's best candidate; only a script's candidates are scored.

    A script that no language was seen in leaves all of them.
    """
    langs, logp, left = model
    out = np.full((len(start), len(langs)), OFF_SCRIPT, np.float32)
    size = np.diff(np.append(start, len(bucket)))
    for s in np.unique(script):
        mine = np.flatnonzero(script == s)
        cand = np.flatnonzero(left[s]) if left[s].any() else np.arange(len(langs))
        whole = len(mine) == len(start)
        b = bucket if whole else bucket[np.repeat(script == s, size)]
        first = start if whole else np.cumsum(size[mine]) - size[mine]
        part = np.stack([np.add.reduceat(logp[c][b], first) for c in cand], axis=1)
        out[mine[:, None], cand[None, :]] = part - part.max(axis=1, keepdims=True)
    return out


def _step_order(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments by falling length, and how many of them have a word at each step."""
    order = np.argsort(-size, kind="stable")
    return order, np.searchsorted(-size[order], -np.arange(int(size.max(initial=0))), "left")


def forward(scores: np.ndarray, begin: np.ndarray, size: np.ndarray, start: np.ndarray, chained: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """For each word where the best path to each label comes from, and the state after each segment, less its maximum.

    Segments run side by side. Those that are ``chained`` start in the state after the segment before, so they run again
    until that does not change; it soon forgets how it started.
    """
    n, k = scores.shape
    back = np.empty((n, k), np.min_scalar_type(k))
    own, end, todo = np.arange(k, dtype=back.dtype), start.copy(), np.arange(len(size))
    while len(todo):
        order, active = _step_order(size[todo])
        todo = todo[order]
        v, at = start[todo], begin[todo]
        for t, a in enumerate(active):
            now = v[:a]
            stay = now >= -penalty
            back[at[:a] + t] = np.where(stay, own, now.argmax(axis=1)[:, None])
            now = np.maximum(now, -penalty) + scores[at[:a] + t]
            v[:a] = now - now.max(axis=1, keepdims=True)
        end[todo] = v
        later = np.flatnonzero(chained)
        todo = later[(start[later] != end[later - 1]).any(axis=1)]
        start[todo] = end[todo - 1]
    return back, end


def backward(back: np.ndarray, begin: np.ndarray, size: np.ndarray, chained: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The label of every word, and that before each segment; ``last`` is that of each segment with none chained to it."""
    k = back.shape[1]
    order, active = _step_order(size)
    label = np.empty_like(back)  # for each label that the segment could end in
    now = np.tile(np.arange(k, dtype=back.dtype), (len(size), 1))
    stop = (begin + size)[order]
    for t, a in enumerate(active):
        at = stop[:a] - 1 - t
        label[at] = now[:a]
        now[:a] = np.take_along_axis(back[at], now[:a], axis=1)
    before = np.empty_like(now)
    before[order] = now
    end, first = last.copy(), np.empty(len(size), np.int64)
    for i in range(len(size) - 1, -1, -1):
        first[i] = before[i, end[i]]
        if chained[i]:
            end[i - 1] = first[i]
    return label[np.arange(len(label)), np.repeat(end, size)].astype(np.int64), first


def _segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts (none empty) cut every SEGMENT words: first word, words, and whether the segment continues a text."""
    n = -(-counts // SEGMENT)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    size = np.minimum(SEGMENT, np.repeat(counts, n) - place * SEGMENT)
    return np.cumsum(size) - size, size, place > 0


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word of each text: sums of scores, less a penalty for each change.

    A text on which no other label gains half the penalty over any stretch keeps its best single label,
    which is then the best path; the others go through the recursion.
    """
    n, k = scores.shape
    label = np.zeros(n, np.int64)
    if not n or k == 1:
        return label
    live = np.flatnonzero(counts)
    first = np.cumsum(counts)[live] - counts[live]
    best = np.add.reduceat(scores, first, axis=0, dtype=np.float64).argmax(axis=1)
    label[:] = np.repeat(best, counts[live])
    group = np.repeat(np.arange(len(live)), counts[live])
    own = scores[np.arange(n), label]
    most = np.zeros(len(live))
    for c in range(k):  # one label at a time, so that the arrays are no larger than the scores
        gain = scores[:, c].astype(np.float64) - own
        run = np.cumsum(gain)
        far = 4 * (np.abs(run).max() + 1)
        low = np.minimum.accumulate(run - gain - far * group) + far * group
        most = np.maximum(most, np.maximum.reduceat(run - low, first))
    todo = np.flatnonzero(most > penalty / 2)
    if len(todo):
        words = np.flatnonzero(np.isin(group, todo))
        begin, size, chained = _segments(counts[live][todo])
        back, end = forward(scores[words], begin, size, np.zeros((len(size), k)), chained, penalty)
        label[words] = backward(back, begin, size, chained, end.argmax(axis=1))[0]
    return label


class Labels:
    """Of each text: words, words by label, words of a script that some language was seen in, and spans."""

    def __init__(self, model: tuple, penalty: float):
        self.model, self.penalty, self.k = model, penalty, len(model[0])
        self.known_script = model[2].any(axis=1)

    def _scored(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts, bucket, start, script = _words(texts)
        scores = word_scores(self.model, bucket, start, script) if len(start) else np.empty((0, self.k), np.float32)
        return counts, scores, self.known_script[script]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Texts that fit into memory together: words, votes [text, label], known words, spans' text, first word, words, label."""
        counts, scores, known = self._scored(texts)
        return self._summed(counts, viterbi(scores, counts, self.penalty), known)

    def _summed(self, counts: np.ndarray, label: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
        text = np.repeat(np.arange(len(counts)), counts)
        votes = np.bincount(text * self.k + label, minlength=len(counts) * self.k).reshape(len(counts), self.k)
        new = np.ones(len(label), bool)
        new[1:] = (label[1:] != label[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        first = np.cumsum(counts) - counts
        return counts, votes, np.bincount(text, weights=known, minlength=len(counts)), text[at], at - first[text[at]], np.diff(np.append(at, len(label))), label[at]

    def _forward(self, scores: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, size, chained = _segments(np.array([len(scores)]))
        start = np.zeros((len(size), self.k))
        start[0] = state
        return forward(scores, begin, size, start, chained, self.penalty)

    def of_long(self, text: pa.Array, limit: int) -> tuple[np.ndarray, ...]:
        """One text in pieces: forward with the state kept at each border, then backward piece by piece."""
        raw = text_arrays(text)[0]
        edges = _edges(raw, limit)

        def piece(i: int) -> pa.Array:
            return pa.array([raw[edges[i] : edges[i + 1]].tobytes()], pa.large_binary())

        state, states, known, total = np.zeros(self.k), [], 0, 0
        for i in range(len(edges) - 1):
            counts, scores, seen = self._scored(piece(i))
            states.append(state)
            if len(scores):
                state = self._forward(scores, state)[1][-1]
            known, total = known + int(seen.sum()), total + int(counts[0])
        votes, spans, end, now = np.zeros((1, self.k), np.int64), [], total, int(state.argmax())
        for i in range(len(edges) - 2, -1, -1):
            scores = self._scored(piece(i))[1]
            if not len(scores):
                continue
            begin, size, chained = _segments(np.array([len(scores)]))
            label, before = backward(self._forward(scores, states[i])[0], begin, size, chained, np.full(len(size), now))
            now = int(before[0])
            votes[0] += np.bincount(label, minlength=self.k)
            at = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
            end -= len(label)
            spans += [(end + int(a), int(n), int(label[a])) for a, n in zip(at[::-1], np.diff(np.append(at, len(label)))[::-1], strict=True)]
        merged: list[list[int]] = []
        for a, n, c in reversed(spans):
            if merged and merged[-1][2] == c:
                merged[-1][1] += n
            else:
                merged.append([a, n, c])
        a, n, c = np.array(merged, np.int64).reshape(-1, 3).T
        return np.array([total]), votes, np.array([known]), np.zeros(len(a), np.int64), a, n, c


def _labelled(model: tuple, penalty: float, batch: pa.RecordBatch, text: int, lettered: int) -> Iterator[tuple]:
    """Parts of a batch, each with prediction (index, or that after the last language), score, share of known words, and spans."""
    labels = Labels(model, penalty)
    k, limit = labels.k, held_bytes(labels.k)
    for part in chunks(batch, batch.schema.names[text], limit, at=text):
        col, letters = part.column(text), np.asarray(part.column(lettered))
        if not k:
            n = part.num_rows
            none = np.empty(0, np.int64)
            yield part, np.zeros(n, np.int64), np.zeros(n), np.zeros(n), (none, none, none, none)
            continue
        long = part.num_rows == 1 and len(text_arrays(col)[0]) > limit
        counts, votes, known, *spans = labels.of_long(col, limit) if long else labels.of(col)
        some = letters & (counts > 0)
        words = np.maximum(counts, 1)
        yield part, np.where(some, votes.argmax(axis=1), k), np.where(some, votes.max(axis=1) / words, 0.0), np.where(some, known / words, 0.0), spans


def _labeller(shared, penalty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value[0], "und"], dtype=object)
        for batch in batches:
            for part, pred, score, _, (text, first, size, label) in _labelled(shared.value, penalty, batch, 1, 2):
                spans = pa.StructArray.from_arrays([pa.array(names[label].tolist(), pa.string()), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32))], ["lang", "first_word", "n_words"])
                per = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=part.num_rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[pred].tolist(), pa.string()), pa.array(score), pa.ListArray.from_arrays(per, spans)], ["doc_id", "lang_pred", "score", "spans"])

    return run


def _filter(shared, penalty: float, least: float, text: int):
    """Rows with one more column in front that says whether the text has a letter; what stays, without it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pred, _, known, _ in _labelled(shared.value, penalty, batch, text + 1, 0):
                ok = (pred < len(shared.value[0])) & (known >= least)
                yield pa.RecordBatch.from_arrays(part.columns[1:], part.schema.names[1:]).filter(pa.array(ok))

    return run


def _lettered(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _known(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))


def accepted(docs: DataFrame, least: float = 0.5, train_rows: int = TRAIN_ROWS, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The documents, columns as given, that have a language and at least the share ``least`` of whose words are in a script of the languages learned."""
    if not isinstance(docs.schema["text"].dataType, StringType):
        raise TypeError("text is no string column")
    model = docs.sparkSession.sparkContext.broadcast(train(_known(docs), train_rows))
    rows = docs.select(_lettered(F.col("text")).alias(fresh(docs, "lettered")), *[docs[c] for c in docs.columns])
    return rows.mapInArrow(_filter(model, penalty, least, docs.columns.index("text")), docs.schema)


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Columns doc_id, held_out, lang_pred, score (share of the words that have that label), spans."""
    docs = _known(docs)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, train_rows))
    out = docs.select("doc_id", "text", _lettered(F.col("text")).alias("lettered")).mapInArrow(_labeller(model, penalty), RESULT)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")
