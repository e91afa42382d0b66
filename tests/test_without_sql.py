"""Queries that SQL cannot state (other hashes, arbitrary signs, an encoder), each against a plain version."""

import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from barloom.operators import quality, samples, vectors
from barloom.plans import registry
from barloom.plans.harness import Inputs


def test_subsample(spark, sf_dir):
    got = registry.QUERIES["t09_subsample"](spark, sf_dir).collect()
    bars = {(r.code, r.trade_date_idx) for r in Inputs(spark, sf_dir).bars.select("code", "trade_date_idx").collect()}
    n, kept = Counter(c for c, _ in bars), Counter(r.code for r in got)
    assert kept == {c: max(1, int(x * 0.1)) for c, x in n.items()}
    assert {(r.code, r.trade_date_idx) for r in got} <= bars and len({(r.code, r.trade_date_idx) for r in got}) == len(got)
    again = registry.QUERIES["t09_subsample"](spark, sf_dir).repartition(3).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in got}


def test_epoch_order(spark, sf_dir):
    ids = {tuple(r) for r in registry.QUERIES["d01_sample_ids"](spark, sf_dir).collect()}
    got = registry.QUERIES["d06_epoch_order"](spark, sf_dir).collect()
    assert {(r.code, r.date) for r in got} == ids and sorted(r.place for r in got) == list(range(len(ids)))
    order = [(r.code, r.date) for r in sorted(got, key=lambda r: r.place)]
    assert order != sorted(order)
    shards = [r.shard for r in sorted(got, key=lambda r: r.place)]
    assert shards == sorted(shards)


def test_epoch_order_resumes(spark):
    ids = spark.createDataFrame([(f"c{i % 7}", i) for i in range(500)], "code string, date int")
    whole = sorted((r.place, r.code, r.date) for r in samples.epoch_order(ids, 3, 1).collect())
    assert sorted((r.place, r.code, r.date) for r in samples.epoch_order(ids.repartition(5), 3, 1, start=123).collect()) == whole[123:]
    other = sorted((r.place, r.code, r.date) for r in samples.epoch_order(ids, 3, 2).collect())
    assert [x[1:] for x in other] != [x[1:] for x in whole]


def test_seeded_batches(spark):
    ids = spark.createDataFrame([(f"c{i % 7}", i // 7) for i in range(500)], "code string, date int")
    got = samples.ordered_batches(ids, 16, seed=4).collect()
    assert Counter(r.batch for r in got) == {b: 16 if b < 31 else 4 for b in range(32)} and samples.batch_count(500, 16) == 32
    assert {(r.code, r.date) for r in got} == {(f"c{i % 7}", i // 7) for i in range(500)}
    assert sorted(map(tuple, got)) == sorted(map(tuple, samples.ordered_batches(ids.repartition(3), 16, seed=4).collect()))
    assert len({r.date for r in got if r.batch == 0}) > 3
    last = samples.ordered_batches(ids, 16, drop_last=True, skip=5, limit=7).collect()
    assert sorted({r.batch for r in last}) == list(range(5, 12)) and samples.batch_count(500, 16, True) == 31


def test_projection(spark, sf_dir):
    rows = Inputs(spark, sf_dir).vectors.select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in rows], float)
    x -= x.mean(axis=0)
    want = x @ np.linalg.svd(x, full_matrices=False)[2][:16].T
    got = {r.vec_id: r.projected for r in registry.QUERIES["m01_projection"](spark, sf_dir).collect()}
    y = np.array([got[r.vec_id] for r in rows])
    sign = np.sign((y * want).sum(axis=0))
    assert len(got) == len(rows) and np.allclose(y * sign, want, atol=1e-6)


def test_projection_keeps_the_last_row_of_a_key(spark):
    rng = np.random.default_rng(1)
    d = spark.createDataFrame([(i % 10, i, rng.normal(size=20).tolist()) for i in range(60)], "id long, at long, embedding array<double>")
    model = vectors.fit_projection(d, 3)
    last = {r.id: r.projected for r in vectors.apply_projection(d.where("at >= 50"), model, "id").collect()}
    assert {r.id: r.projected for r in vectors.apply_projection(d, model, "id", "at").collect()} == last


def test_vector_store(spark, sf_dir):
    texts = [r.title for r in Inputs(spark, sf_dir).announcements.select("title").distinct().collect()]
    got = registry.QUERIES["m02_embed_new"](spark, sf_dir).collect()
    assert sorted(r.text for r in got) == sorted(texts)
    for r in got[:50]:
        v = defaultdict(float)
        for w in r.text.split():
            h = zlib.crc32(w.encode())
            v[h % 64] += 1 if h & 0x10000 else -1
        norm = max(sum(x * x for x in v.values()) ** 0.5, 1e-12)
        assert np.allclose(r.vector, [v[i] / norm for i in range(64)])


def test_all_complete(spark):
    report = spark.createDataFrame([("a", True), ("b", True)], "code string, complete boolean")
    assert quality.all_complete(report).first().complete and quality.all_complete(report.limit(0)).first().complete
    assert not quality.all_complete(report.withColumn("complete", F.col("code") == "a")).first().complete


def test_day_audit_of_a_long_window(spark):
    rows = spark.sql("SELECT date_add(date'2024-01-01', CAST(id AS INT)) AS day FROM range(80)")
    declared = rows.groupBy("day").agg(F.count("*").alias("declared"))
    assert quality.day_audit(rows, declared, 10).where("fallback").count() == 0
    assert quality.day_audit(rows, declared, 10, most_days=60).where("fallback").count() == 80


def test_holes_with_a_floor(spark):
    days = spark.sql("SELECT date_add(date'2024-01-01', CAST(id AS INT)) AS day FROM VALUES 0, 1, 3 AS t(id)")
    assert [(str(r.day), r.covered_floor) for r in quality.holes(days, "2024-01-01").collect()] == [("2024-01-03", True)]
    assert [r.covered_floor for r in quality.holes(days, "2023-12-31").collect()] == [False]
