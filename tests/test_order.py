"""A global order over as many partitions as the rows need."""

import random

from pyspark.sql import functions as F

from barloom.operators import order, samples


def test_numbered(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = order.numbered(df, F.col("a").desc_nulls_last(), "b", rows_per_part=170).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.place)] == want and sorted(r.place for r in got) == list(range(3000))
    ties = order.numbered(df.select(F.lit(1).alias("x")), "x", rows_per_part=100).collect()
    assert sorted(r.place for r in ties) == list(range(3000))
    assert order.numbered(df.limit(0), "b").count() == 0


def test_shards_follow_the_rows(spark):
    ids = spark.createDataFrame([(f"c{i % 7}", i) for i in range(1000)], "code string, date int")
    assert {r.shard for r in samples.epoch_order(ids, 1, 1, shard_rows=90).collect()} == set(range(12))
    assert {r.shard for r in samples.epoch_order(ids.limit(180), 1, 1, start=100, shard_rows=90).collect()} == {1}


def test_a_call_gets_many_whole_batches(spark):
    rows = [(f"c{i:04d}", day) for day in (1, 2) for i in range(1000 if day == 1 else 9)]
    d = samples.assign_batches(spark.createDataFrame(rows, "code string, date int"), 8).select("code", "date", "batch")

    def sizes(p):
        out = p.groupby(["date", "batch"], as_index=False).agg(n=("code", "size"), first=("code", "min"))
        return out.assign(calls=[1] + [0] * (len(out) - 1))

    schema = "date int, batch int, n long, first string, calls long"
    got = samples.map_batches(d, sizes, schema, per_call=50).collect()
    one = samples.map_batches(d, sizes, schema).collect()
    want = {(1, b, 8, f"c{b * 8:04d}") for b in range(125)} | {(2, 0, 8, "c0000"), (2, 1, 1, "c0008")}
    assert {tuple(r)[:4] for r in got} == {tuple(r)[:4] for r in one} == want and len(got) == len(one) == len(want)
    assert sum(r.calls for r in got) == 4 and sum(r.calls for r in one) == 127
