"""The bucketed store: commits, appends and rewrites by code, batches that come twice, tails read without the history."""

import datetime
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import quality, vectors
from barloom.sources.store import Store, merge_batches, sync
from barloom.streaming import streams

SCHEMA = "code string, date date, close double, tradestatus int"
D0 = datetime.date(2020, 1, 1)


def files(store):
    """Current data files with their times."""
    out = {}
    for p in store.manifest()[0]:
        top = f"{store.path}/runs/{p.run}/_bucket={p.bucket}/_slice={p.slice}"
        out[p] = sorted((f, os.stat(f"{top}/{f}").st_mtime_ns) for f in os.listdir(top) if f.endswith(".parquet"))
    return out


def series(spark, codes, days):
    rng = random.Random(7)
    rows = [(c, D0 + datetime.timedelta(d), rng.random(), int(rng.random() > 0.1)) for c in codes for d in range(days)]
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted(map(tuple, df.select("code", "date", "close", "tradestatus").collect()))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), SCHEMA, buckets=4, slice_days=100)


def test_versions(spark, store):
    assert store.version() == 0 and store.read().count() == 0 and store.tail(5).count() == 0
    store.change(append=series(spark, ["a", "b"], 10))
    store.change(replace=series(spark, ["b"], 3))
    assert store.version() == 2 and {r.code: r["count"] for r in store.read().groupBy("code").count().collect()} == {"a": 10, "b": 3}
    assert store.read(store.manifest(1)[0]).count() == 20
    store._commit(2, store.manifest()[0], {})
    with pytest.raises(RuntimeError):
        store._commit(2, [], {})
    store.change(replace=series(spark, ["b"], 0), keys=spark.createDataFrame([("b",)], "code string"))
    assert {r.code for r in store.read().collect()} == {"a"}


def test_a_batch_counts_once(spark, store):
    d = series(spark, ["a"], 4)
    assert store.change(append=d, batch=("s", 0)) and not store.change(append=d, batch=("s", 0)) and store.change(append=d, batch=("t", 0))
    assert store.read().count() == 8 and store.manifest()[1] == {"s": 0, "t": 0}


def test_incremental_equals_rebuild(spark, store):
    rng = random.Random(11)
    codes = [f"c{i}" for i in range(12)]
    rows = {(c, d): (c, D0 + datetime.timedelta(d), float(rng.randint(0, 99)), 1) for c in codes for d in range(150)}
    for step in range(4):
        before = {k: v for k, v in rows.items()}
        if step:
            for c in codes[:6]:  # new days
                for d in range(150 + step * 3, 153 + step * 3):
                    rows[c, d] = (c, D0 + datetime.timedelta(d), float(rng.randint(0, 99)), 1)
            changed = codes[5 + step]
            rows[changed, 7] = (changed, D0 + datetime.timedelta(7), 1000.0 + step, None)
            rows.pop((codes[11], step), None)  # a day that is gone
        df = spark.createDataFrame(list(rows.values()), SCHEMA)
        held = files(store)
        got = {r.code: r.kind for r in sync(store, df).collect()}
        want = {}
        for c in codes:
            new, old = ({k[1]: v for k, v in x.items() if k[0] == c} for x in (rows, before))
            fresh = set(new) - set(old)
            same = all(new.get(d) == v for d, v in old.items())
            want[c] = ("rewrite" if not step else "same" if new == old else "append" if same and min(fresh) > max(old) else "rewrite")
        assert got == want
        assert content(store.read()) == content(df)
        rewritten = {r.b for r in df.where(F.col("code").isin([c for c, k in want.items() if k == "rewrite"])).select(store.bucket_of(F.col("code")).alias("b")).distinct().collect()}
        now = files(store)
        assert all(now[p] == f for p, f in held.items() if p.bucket not in rewritten)  # same names, same times
        assert any(p.bucket not in rewritten for p in held) or not step or len(rewritten) == 4
    version = store.version()
    assert {r.kind for r in sync(store, df).collect()} == {"same"} and store.version() == version
    store.compact(most_runs=1)
    assert content(store.read()) == content(df)


def test_codes_that_may_not_be_appended_to_are_rewritten(spark, store):
    store.change(append=series(spark, ["a", "b"], 5))
    more = series(spark, ["a", "b"], 5).unionByName(spark.createDataFrame([(c, D0 + datetime.timedelta(9), 1.0, 1) for c in "ab"], SCHEMA))
    may = spark.createDataFrame([("a", True), ("b", False)], "code string, append boolean")
    assert {(r.code, r.kind) for r in sync(store, more, may).collect()} == {("a", "append"), ("b", "rewrite")}
    assert content(store.read()) == content(more)


def land(spark, path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        os.utime(max((f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getmtime), (1_700_000_000 + i, 1_700_000_000 + i))


BATCHES = [[("a", D0, 1.0, 1), ("b", D0, 2.0, 1), ("a", D0, 1.5, 0)], [("a", D0, 3.0, 1), ("c", D0, 4.0, 1)], [("b", D0 + datetime.timedelta(1), 5.0, 1), ("a", D0 + datetime.timedelta(200), 6.0, 1)]]


@pytest.mark.parametrize("first_wins", [True, False])
def test_a_stream_that_stops_and_starts_again_merges_as_the_batch(spark, store, tmp_path, first_wins):
    merge = (lambda old, new: quality.merge_first_wins(old, new, "code", "close")) if first_wins else (lambda old, new: quality.upsert_last_wins(old, new, ["code", "date"], "close"))
    path = str(tmp_path / "landing")
    land(spark, path, BATCHES)
    want = spark.createDataFrame([], SCHEMA)
    for b in BATCHES:
        want = merge(want, spark.createDataFrame(b, SCHEMA))
    each, tried = merge_batches(store, "feed", merge, first_wins), []

    def fails(batch, number):
        """The second batch is merged, but its end is not noted, so Spark gives it again."""
        each(batch, number)
        tried.append(number)
        if tried == [0, 1]:
            raise RuntimeError("lost")

    for _ in range(2):
        stream = streams.read_batches(spark, path, SCHEMA)
        q = stream.writeStream.foreachBatch(fails).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception:
            assert tried == [0, 1]
    assert tried == [0, 1, 1, 2] and store.manifest()[1] == {"feed": 2}
    assert content(store.read()) == content(want)


def test_tails_leave_the_history_alone(spark, store):
    d = series(spark, [f"c{i}" for i in range(8)], 1000).where("code <> 'c7' or date < '2020-06-01'")
    store.change(append=d)
    store = Store(spark, store.path, SCHEMA, buckets=4, slice_days=100)
    whole = sum(p.rows for p in store.manifest()[0])
    for n, end in ((30, None), (30, "2021-05-05"), (250, None)):
        parts = store.tail_parts(n, end)
        rank = F.row_number().over(Window.partitionBy("code").orderBy(F.desc("date")))
        cut = lambda x: content(x.where(F.lit(True) if end is None else F.col("date") <= end).withColumn("r", rank).where(F.col("r") <= n))  # noqa: E731, B023
        assert cut(store.read(parts)) == cut(d)
        if end is None:
            read = store.tail(n)
            read.collect()
            scan = read._jdf.queryExecution().executedPlan()
            while scan.children().size():
                scan = scan.children().head()
            scanned = scan.metrics().get("numOutputRows").get().value()
            assert scanned == sum(p.rows for p in parts) < whole * (0.35 if n == 30 else 0.6)


def test_only_parts_that_may_hold_a_key_are_read(spark, tmp_path):
    path = str(tmp_path / "texts")
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "text string")

    def encoder(texts):
        return [[float(len(t))] for t in texts]

    first = [f"text {i}" for i in range(400)]
    vectors.append_new(spark, frame([*first, *first, None]), path, encoder, buckets=128)
    store = vectors.text_store(spark, path, 128)
    before = files(store)
    batch = frame(["text 7", "text 8", "new one", "new two"])
    parts = store.parts_of(batch)
    assert 0 < len(parts) <= 4 < len(before) and len(store.read(parts).inputFiles()) == len(parts)
    assert {r.text for r in store.absent(batch).collect()} == {"new one", "new two"}
    got = vectors.append_new(spark, batch, path, encoder, buckets=128)
    assert sorted((r.text, r.vector) for r in got.collect()) == sorted((t, [float(len(t))]) for t in [*first, "new one", "new two"])
    assert all(files(store)[p] == f for p, f in before.items())
    for _ in range(2):  # nothing new
        assert vectors.append_new(spark, batch, path, encoder, buckets=128).count() == 402
