"""The stream's keyed state gives the batch's features, also when the stream stops in the middle and goes on from its checkpoint."""

import datetime
import os
import random

from pyspark.sql import functions as F

from barloom.operators import news
from barloom.streaming import streams

SCHEMA = "ts timestamp, code long, feed string"


def test_features_of_a_stream_that_restarts(spark, tmp_path):
    rng = random.Random(5)
    days = [datetime.date(2025, 1, 1) + datetime.timedelta(n) for n in range(40)]
    days = [d for d in days if d.weekday() < 5]
    calendar = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "date date, tdi int")
    start = datetime.datetime(2025, 1, 1, 16)
    items = sorted((start + datetime.timedelta(minutes=rng.randint(0, 36 * 1440)), rng.choice([1, 1, 1, 2, 3]) if rng.random() < 0.95 else 9, rng.choice(["em", "cls"])) for _ in range(400))
    path, out = str(tmp_path / "landing"), str(tmp_path / "out")
    n_runs = []
    for k in range(4):  # the landed files grow; each time the stream is a new query on the same checkpoint
        spark.createDataFrame(items[k * 100 : (k + 1) * 100], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        newest = max((f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getmtime)
        os.utime(newest, (1_700_000_000 + k, 1_700_000_000 + k))
        stream = streams.read_batches(spark, path, SCHEMA)
        got = streams.drain(streams.session_features(stream, calendar, "1 minute"), out)
        n_runs.append(got.count())
    assert n_runs == sorted(n_runs) and 0 < n_runs[0] < n_runs[-1]
    counts = news.mention_counts(spark.createDataFrame(items, SCHEMA), calendar)
    last = counts.agg(F.max("tdi")).first()[0]  # its session is still open
    want = news.novelty(news.sum3(counts)).where(F.col("tdi") < last)
    cols = ["date", "tdi", "code", "n_em", "n_cls", "n_near", "latest", "n_3d", "novel"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert {r.novel for r in got.collect()} == {0, 1}
    sums = streams.drain(streams.session_counts(streams.read_batches(spark, path, SCHEMA), calendar, "1 minute"), str(tmp_path / "counts"))
    assert sorted(map(tuple, sums.select(*cols[:7]).collect())) == sorted(map(tuple, got.select(*cols[:7]).collect()))
