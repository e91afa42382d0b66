"""A global order of any number of rows, and scratch tables that all executors can read."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors share."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write once to the shared folder and read back; with ``drop_shuffles`` the write's own shuffle files go as soon as it has ended."""
    spark, path, setting = df.sparkSession, scratch_path(df.sparkSession, name), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    if drop_shuffles:
        spark.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: Column | str, rows_per_part: int = 200_000, place: str = "place") -> DataFrame:
    """The rows with their ``place`` (from 0) in a global order; as many range partitions as the rows need, none numbers all of them.

    Rows are dealt by ranges of the order and sorted within them in one shuffle, and written. ``monotonically_increasing_id`` then has
    the partition above 33 bits and the row's number in it below, so that only the sizes of the partitions before have to be added up, one
    row each. Rows that tie in the order get different places. ``df`` is read twice (count, and sampling with the shuffle): give it a stored table.
    """
    parts = max(1, -(-df.count() // rows_per_part))
    d = kept(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    size = d.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    size = size.select("_part", F.coalesce(before, F.lit(0).cast("long")).alias("_before"))
    d = d.join(size, part == F.col("_part"))
    return d.withColumn(place, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")
