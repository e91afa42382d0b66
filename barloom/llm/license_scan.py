"""License scan: exact set-similarity join of text blocks with license templates by containment.

Templates are license texts, notices and phrases of any length. For each length class (powers of two) every text is cut
into overlapping blocks of twice that many words, so that any stretch as long as a template lies whole in the block at which
it starts. A block meets a template when it holds at least the template's share of its distinct words. The join is
exact: words are ordered from globally rare to frequent (counted over the corpus); a pair can meet the
threshold only if both prefixes in that order share a word, the block holds enough template words (length filter)
and enough are left after the shared one (positional filter). Blocks go through this join as rows; what passes is
verified on the whole sets. Sets of few words also meet ordinary prose, so short templates must stand word by
word in the block; the base phrases' places are looked up the same way.

Defined results: null, empty and wordless texts have no words, places or labels and score 0; every row
gives a row, also repeated ones; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, chunks, class_table, materialize, text_arrays, word_hashes, word_spans

WORDS = class_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Templates of fewer distinct words must stand word by word.
SHORT = 8
LEAST_STRIDE = 8

#: Phrases whose places are counted, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Texts and notices of public licenses.
NOTICES = {
    """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
    (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
    publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
    subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
    substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
    NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
    COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
    FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""": "mit",
    """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files""": "mit",
    """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
    the above copyright notice and this permission notice appear in all copies.""": "isc",
    """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
    You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
    writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
    either express or implied. See the License for the specific language governing permissions and limitations under the License.""": "apache-2",
    """Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License""": "apache-2",
    """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published
    by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in
    the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
    PARTICULAR PURPOSE. See the GNU General Public License for more details.""": "gpl-3",
    """This work is licensed under the GNU General Public License version 3""": "gpl-3",
    """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
    are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
    Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution.""": "bsd",
    """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
    this file, You can obtain one at http://mozilla.org/MPL/2.0/.""": "mpl-2",
    """Mozilla Public License Version 2.0""": "mpl-2",
    """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
    distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
    any means.""": "unlicense",
    """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License""": "cc-by-nc",
    """Creative Commons Attribution NonCommercial""": "cc-by-nc",
    """All rights reserved""": "all-rights-reserved",
}
THRESHOLD = 0.8

BLOCK = "array<struct<stride:int,block:int,tokens:array<int>,words:array<string>>>"
DOC = f"uid long, doc_id long, n_words long, blocks {BLOCK}"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def templates() -> list[tuple[str, str, bool, float]]:
    """(text, label, whether its places are counted, share of its distinct words that a block must hold)."""
    return [(t, label, True, 1.0) for t, label in BASE.items()] + [(t, label, False, THRESHOLD) for t, label in NOTICES.items()]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate({i: i + 32 for i in range(65, 91)}))


def stride_of(text: str) -> int:
    """The length class of a template: the next power of two."""
    return max(LEAST_STRIDE, 1 << (len(words_of(text)) - 1).bit_length())


def _lookup(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, sorted, and which word each is."""
    buf, offsets = text_arrays(pa.array(tokens))
    h = word_hashes(buf, offsets[:-1], offsets[1:])
    order = np.argsort(h)
    return h[order], order


def _split(texts: pa.Array, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, words' starts and ends, words per text, and each word's place in ``tokens`` or -1."""
    raw, offsets = text_arrays(texts)
    buf = LOWER[raw]
    s, e, counts = word_spans(buf, offsets, WORDS)
    known, order = _lookup(tokens)
    h = word_hashes(buf, s, e)
    i = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return buf, s, e, counts, np.where(known[i] == h, order[i], -1)


def _frequencies(tokens: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for part in chunks(batch):
                at = _split(part.column(0), tokens)[4]
                n += np.bincount(at[at >= 0], minlength=len(tokens))
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(n)], ["token", "n"])

    return run


def _blocks(tokens: list[str], classes: list[tuple[int, np.ndarray, np.ndarray, bool]]):
    """Tokens are in global order, rarest first. Of each class: stride, its templates' tokens, those of their prefixes, and whether words are needed.

    Blocks without a prefix token can meet nothing.
    """
    kind = pa.list_(pa.struct([("stride", pa.int32()), ("block", pa.int32()), ("tokens", pa.list_(pa.int32())), ("words", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in chunks(batch):
                buf, s, e, counts, at = _split(part.column(1), tokens)
                first = np.cumsum(counts) - counts
                rows: list[list] = [[] for _ in range(len(counts))]
                known = np.flatnonzero(at >= 0)
                known_doc = np.searchsorted(first + counts, known, "right")
                for stride, own, prefix, spelled in classes:
                    use = own[at[known]]
                    hit, doc = known[use], known_doc[use]
                    n_blocks = counts // stride + 1
                    base = np.cumsum(n_blocks) - n_blocks
                    block = (hit - first[doc]) // stride
                    place, tok = np.concatenate([base[doc] + block, base[doc] + block - 1]), np.tile(at[hit], 2)
                    ok = np.concatenate([np.ones(len(hit), bool), block > 0])
                    place, tok = place[ok], tok[ok]
                    live = np.zeros(int(n_blocks.sum()), bool)
                    live[place[prefix[tok]]] = True
                    place, tok = place[live[place]], tok[live[place]]
                    if not len(place):
                        continue
                    order = np.lexsort((tok, place))
                    place, tok = place[order], tok[order]
                    new = np.ones(len(place), bool)
                    new[1:] = (place[1:] != place[:-1]) | (tok[1:] != tok[:-1])
                    place, tok = place[new], tok[new]
                    edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
                    for a, b in zip(edge[:-1], edge[1:], strict=True):
                        d = int(np.searchsorted(base, place[a], "right")) - 1
                        k = int(place[a] - base[d])
                        lo = first[d] + k * stride
                        hi = min(lo + 2 * stride, first[d] + counts[d])
                        words = [buf[x:y].tobytes().decode() for x, y in zip(s[lo:hi], e[lo:hi], strict=True)] if spelled else None
                        rows[d].append({"stride": stride, "block": k, "tokens": tok[a:b].tolist(), "words": words})
                n = len(counts)
                yield pa.RecordBatch.from_arrays([pa.array(uid + np.arange(n)), part.column(0), pa.array(counts.astype(np.int64)), pa.array(rows, kind)], ["uid", "doc_id", "n_words", "blocks"])
                uid += n

    return run


def template_index(spark: SparkSession, order: list[str], known: list[tuple[str, str, bool, float]]) -> tuple[DataFrame, DataFrame, list[tuple]]:
    """The templates, their prefix tokens, and the length classes; as small as the list of templates."""
    rank = {t: i for i, t in enumerate(order)}
    rows, index, classes = [], [], {}
    for i, (text, label, base, share) in enumerate(known):
        words, stride = words_of(text), stride_of(text)
        ids = sorted(rank[w] for w in set(words))
        need = ceil(share * len(ids) - 1e-9)
        spelled = base or len(ids) < SHORT
        rows.append((i, label, base, words if spelled else None, ids, len(ids), need, stride))
        index += [(t, i, at, len(ids), need, stride) for at, t in enumerate(ids[: len(ids) - need + 1])]
        own, prefix, any_spelled = classes.get(stride, (set(), set(), False))
        classes[stride] = (own | set(ids), prefix | set(ids[: len(ids) - need + 1]), any_spelled or spelled)
    t = spark.createDataFrame(rows, "template int, label string, base boolean, phrase array<string>, ids array<int>, size int, need int, stride int")
    masks = [(stride, *(np.isin(np.arange(len(order)), list(x)) for x in (own, prefix)), spelled) for stride, (own, prefix, spelled) in sorted(classes.items())]
    return t, spark.createDataFrame(index, "token int, template int, i int, size int, need int, stride int"), masks


def scan(docs: DataFrame, known: list[tuple[str, str, bool, float]] | None = None) -> DataFrame:
    """Columns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks (those that meet a template)."""
    spark = docs.sparkSession
    known = known or templates()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = sorted({w for t in known for w in words_of(t[0])})
    counts = docs.select("text").mapInArrow(_frequencies(tokens), "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    often = {r["token"]: r["n"] for r in counts}  # one number per template word
    order = sorted(tokens, key=lambda t: (often.get(t, 0), t))
    table, index, classes = template_index(spark, order, known)

    rows = materialize(docs.mapInArrow(_blocks(order, classes), DOC), "license-blocks")
    block = rows.select("uid", F.explode("blocks").alias("b")).select("uid", "b.stride", "b.block", "b.words", "b.tokens", F.size("b.tokens").alias("held"))
    shared = block.select("uid", "stride", "block", "held", F.posexplode("tokens").alias("j", "token")).join(F.broadcast(index), ["token", "stride"])
    pair = shared.where("held >= need and j <= held - need and 1 + least(size - i, held - j) - 1 >= need").select("uid", "stride", "block", "template").distinct()
    pair = pair.join(F.broadcast(table.drop("stride")), "template").join(block, ["uid", "stride", "block"])
    share = F.size(F.array_intersect("tokens", "ids")) / F.col("size")
    met = pair.withColumn("share", share).where(F.size(F.array_intersect("tokens", "ids")) >= F.col("need"))
    starts = F.filter(F.sequence(F.lit(1), F.col("stride")), lambda i: F.slice("words", i, F.size("phrase")) == F.col("phrase"))
    met = met.withColumn("places", F.when(F.col("phrase").isNotNull(), F.transform(starts, lambda i: F.col("block") * F.col("stride") + i - 1)))
    met = met.where(F.col("base") | F.col("phrase").isNull() | (F.size("places") > 0))
    found = F.col("base") & (F.size("places") > 0)
    hits = met.groupBy("uid").agg(
        F.sum(F.when(found, F.size("places")).otherwise(0)).alias("n_base"),
        F.min(F.when(found, F.array_min("places"))).alias("first_word"),
        F.max(F.when(found, F.array_max("places"))).alias("last_word"),
        F.collect_set(F.when(found, F.col("label"))).alias("base_set"),
        F.collect_set("label").alias("all_set"),
        F.max("share").alias("score"),
        F.sort_array(F.collect_set(F.struct("stride", "block", "label", "share"))).alias("blocks"),
    )

    def joined(name: str):
        return F.coalesce(F.array_join(F.sort_array(F.col(name)), ","), F.lit(""))

    return rows.drop("blocks").join(hits, "uid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        joined("base_set").alias("base_labels"), joined("all_set").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "blocks",
    )
