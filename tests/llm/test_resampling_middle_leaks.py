"""Operators 11 to 13 against brute force and DuckDB: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from barloom.llm import decontamination, fill_in_middle, importance_resampling, queries
from tests.test_oracles import rows

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
RNG = random.Random(3)
VOCAB = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "ABC"]
ITEMS = [(1, " ".join(RNG.choices(VOCAB, k=25))), (2, " ".join(RNG.choices(VOCAB, k=12))), (10, "Rare-Pair"), (3, None), (4, "..."), (5, "a a a a a a a a a a a"), (5, " ".join(RNG.choices(VOCAB, k=30))), (None, "unnamed item of six whole words")]


def leaky():
    out = [None, "", " .. ", "one", "rare  PAIR", "rarepair", "a " * 40, "a " * 9, "the unnamed. item, of six whole words!", "<P> held", "a<", "é" * 700, "x" * 5000]
    for _ in range(90):
        w = RNG.choices(VOCAB, k=RNG.randint(5, 80))
        if RNG.random() < 0.6:
            item = RNG.choice(ITEMS)[1] or "nothing"
            x = item.split()
            a = RNG.randrange(len(x))
            w[RNG.randrange(len(w)) :] = x[a : a + RNG.randint(8, 20)] + w[-3:]
        out.append(RNG.choice([" ", ", ", "\n"]).join(w))
    return out + [ITEMS[0][1] + " and " + ITEMS[0][1].upper()]


ROWS = [(i, t) for i, t in enumerate(leaky())] + [(50, "again"), (50, ITEMS[1][1]), (7, "a " * 9), (None, ITEMS[0][1]), (None, ITEMS[0][1])]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return d.withColumns({"n_words": F.lit("x"), "key": F.lit(1), "score": F.lit(None).cast("int"), "form": F.lit(2)})


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id int, text string").withColumn("phrase", F.lit("x"))


def words(text):
    return WORD.findall((text or "").encode().translate(LOW))


def leaks(text, width=10):
    w, hit, found = words(text), set(), set()
    for item, t in ITEMS:
        x = words(t)
        for a in range(max(len(x) - width, 0) + 1 if x else 0):
            run = x[a : a + width]
            for p in range(len(w) - len(run) + 1):
                if w[p : p + len(run)] == run:
                    hit.update(range(p, p + len(run)))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination(docs, items):
    got = decontamination.contamination(docs, items).collect()
    want = [(i, *leaks(t)) for i, t in ROWS]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == sorted(want, key=str)
    assert sum(w[5] for w in want) > 15
    assert all(set(r["items"]) <= set(r.near_items) for r in got)
    clean = decontamination.clean_documents(docs, items)
    assert clean.columns == docs.columns and Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(r for r, w in zip(ROWS, want, strict=True) if not w[5])


def test_decontamination_beyond_a_broadcast_and_a_slot(docs, items, monkeypatch):
    want = sorted(map(str, decontamination.contamination(docs, items).collect()))
    monkeypatch.setattr(decontamination, "MOST_TERMS", 0)
    monkeypatch.setattr(decontamination, "SLOT", 3)
    monkeypatch.setattr(decontamination, "MOST_KEYS", 0)
    assert sorted(map(str, decontamination.contamination(docs, items, lists=4).drop("near_items").collect())) == sorted(map(str, decontamination.contamination(docs, items).drop("near_items").collect()))
    assert sorted(map(str, decontamination.contamination(docs, items).collect())) == want


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id int, text string")
    texts = ["alpha beta gamma delta", "alpha x beta gamma y delta", "alpha x x x beta gamma delta", "delta gamma beta alpha", "beta gamma delta", "alpha beta x gamma delta alpha"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.near_items, r.n_items) for r in decontamination.contamination(docs, items, width=4, lists=4, slop=2).collect()}

    def near(text):
        w, x = text.split(), "alpha beta gamma delta".split()
        rare = sorted((sum(t.split().count(y) for t in texts), k, y) for k, y in enumerate(x))
        _, k, y = rare[0]
        return any(all(any(abs(q - (p - k + j)) <= 2 for q, v in enumerate(w) if v == z) for _, j, z in rare[1:]) for p, v in enumerate(w) if v == y)

    assert {d: bool(x[0]) for d, x in got.items()} == {d: near(t) for d, t in enumerate(texts)}
    assert [got[d][1] for d in range(6)] == [1, 0, 0, 0, 0, 0] and got[1][0] and not got[2][0]


@pytest.mark.parametrize("lengths", [(1, 1), (1, 3), (2, 2)])
def test_resampling(docs, items, lengths):
    def spans(text):
        w = words(text)
        return [b" ".join(w[i : i + n]) for n in range(lengths[0], lengths[1] + 1) for i in range(len(w) - n + 1)]

    k = 100
    held = {r: Counter(zlib.crc32(x) % k for x in spans(r[1])) for r in ROWS}
    s, t = Counter(), Counter()
    for r in ROWS:
        s.update(held[r])
    for _, x in ITEMS:
        t.update(zlib.crc32(y) % k for y in spans(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + k) / ((s[b] + 1) * (T + k)))) for b in range(k)]
    want = []
    for doc_id, text in ROWS:
        c = held[doc_id, text]
        n = sum(c.values())
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * m for b, m in c.items()) // n if n else 0
        want.append((doc_id, len(words(text)), n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((w for w in want if w[1] >= 20), key=lambda w: (-w[4], w[0] is None, w[0] or 0))
    drawn = Counter({(*w, i + 1): 1 for i, w in enumerate(able[: 40 * len(able) // 100])})
    rest = Counter(want) - Counter(x[:5] for x in drawn)
    got = importance_resampling.resampled(docs, items, percent=40, lengths=lengths, buckets=k).collect()
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got) == drawn + Counter({(*x, None): n for x, n in rest.items()})


def test_drawn_documents(docs, items):
    d = importance_resampling.drawn_documents(docs, items, percent=30)
    drawn = {(r.doc_id, r.score) for r in importance_resampling.resampled(docs, items, percent=30).where("rank is not null").collect()}
    assert d.columns == docs.columns and 0 < d.count() and {r.doc_id for r in d.collect()} == {x[0] for x in drawn}


def middle(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(spark, docs):
    got = fill_in_middle.fill_in_middle(docs)
    more = spark.createDataFrame([(i, t) for i in range(1000, 1100) for t in ("<", "<S>", "a<P", "日<本>é", "></M>")], "doc_id long, text string")
    for frame in (docs, more):
        out = fill_in_middle.fill_in_middle(frame).collect()
        want = Counter()
        for r in frame.collect():
            n, form, a, b, o = middle(r.doc_id, r.text)
            want[r.doc_id, n, form, a, b, o, hashlib.sha256(o.encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
        assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256, r.restored_sha256) for r in out) == want
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert Counter(map(tuple, fill_in_middle.restore(got).collect())) == Counter((i, t or "") for i, t in ROWS)


def test_pieces_over_several_blocks(monkeypatch):
    import numpy as np

    monkeypatch.setattr(fill_in_middle, "BLOCK", 7)
    text = "aé日𝄞" * 9
    data = np.frombuffer(text.encode(), np.uint8)
    assert fill_in_middle.code_points(data) == len(text)
    assert [fill_in_middle.byte_at(data, i) for i in range(len(text) + 1)] == [len(text[:i].encode()) for i in range(len(text) + 1)]
    assert fill_in_middle.cut([(0, 0, 4), (1, 3, 6)], 4) == [(0, 0, 4), (1, 3, 3), (1, 3, 6)] and fill_in_middle.cut([(0, 2, 9)], 3) == [(0, 2, 5), (0, 5, 9)]


def test_empty_tables(docs, items):
    no_docs, no_items = docs.limit(0), items.limit(0)
    for d, i in ((no_docs, items), (docs, no_items), (no_docs, no_items)):
        n = d.count()
        assert decontamination.contamination(d, i).where("not contaminated and n_items = 0").count() == n
        assert importance_resampling.resampled(d, i).count() == n
    assert fill_in_middle.fill_in_middle(no_docs).count() == 0


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_fill_in_middle", "op13_decontamination"])
def test_matches_duckdb(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    found = c.execute(queries.ORACLE_SQL[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in found.description], found.fetchall())
