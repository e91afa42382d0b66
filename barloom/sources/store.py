"""A table in buckets of a key and slices of days, whose current files a manifest names.

Each write is a run in a folder of its own, ``runs/<run>/_bucket=<b>/_slice=<s>``, sorted by key and day; a bucket's slice in a run is a part. A
manifest, one small JSON file for each version, lists the parts that are current. Writing it is the commit: a job that dies before leaves files
that nothing names. Two writers of one version cannot both commit, since the file is made under its final name only where there is none.

* Appending adds a run; other parts keep their files.
* Replacing rewrites the buckets that hold one of the keys; other buckets keep their files.
* A stream's batches carry a name and number; a batch whose number the manifest already has changes nothing.
* An index (key, bucket, slice, rows) of each run tells which parts hold the last rows of every key, so tails are read without the history.

Only names and counts of parts come to the driver: buckets x slices x runs since the last ``compact``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import kept


class Part(NamedTuple):
    run: str
    bucket: int
    slice: int
    rows: int


class Store:
    """``key`` and ``day`` name columns of ``schema`` (day: or none); ``counted`` is a condition on rows of which tails have so many."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str = "code", day: str | None = "date", buckets: int = 16, slice_days: int = 256, counted: str = "true"):
        self.spark, self.path, self.key, self.day = spark, path.rstrip("/"), key, day
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.buckets, self.slice_days, self.counted = buckets, slice_days, counted

    # ------------------------------------------------ manifest

    def _files(self):
        """Spark's file system for the path, whatever store it is in, and a maker of paths."""
        make = self.spark._jvm.org.apache.hadoop.fs.Path
        return make(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), make

    def version(self) -> int:
        """The latest committed version; 0 before the first."""
        fs, make = self._files()
        at = make(f"{self.path}/manifest")
        if not fs.exists(at):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> tuple[list[Part], dict[str, int]]:
        """The current parts, and the last batch of each stream."""
        version = self.version() if version is None else version
        if not version:
            return [], {}
        held = json.loads(self.spark.read.text(f"{self.path}/manifest/{version:010d}.json", wholetext=True).first().value)
        return [Part(*p) for p in held["parts"]], held["batches"]

    def _commit(self, base: int, parts: list[Part], batches: dict[str, int]) -> None:
        fs, make = self._files()
        final = make(f"{self.path}/manifest/{base + 1:010d}.json")
        draft = make(f"{self.path}/manifest/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps({"parts": sorted(parts), "batches": batches}).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"version {base + 1} was committed by another writer")

    # ------------------------------------------------ rows

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.hash(key.cast("string")), F.lit(self.buckets))

    def _slice_of(self, day: Column) -> Column:
        return F.floor(F.date_diff(F.to_date(day), F.lit("1970-01-01").cast("date")) / self.slice_days).cast("int")

    def _folder(self, p: Part) -> str:
        return f"{self.path}/runs/{p.run}/_bucket={p.bucket}/_slice={p.slice}"

    def read(self, parts: list[Part] | None = None) -> DataFrame:
        parts = self.manifest()[0] if parts is None else parts
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*map(self._folder, parts))

    def parts_of(self, keys: DataFrame) -> list[Part]:
        """The current parts that may hold one of the keys; others need not be read."""
        buckets = {r.b for r in keys.select(self.bucket_of(F.col(self.key)).alias("b")).distinct().collect()}
        return [p for p in self.manifest()[0] if p.bucket in buckets]

    def absent(self, new: DataFrame) -> DataFrame:
        """Rows of ``new`` whose key the store lacks; only the key column of the parts that may hold them is read."""
        return new.join(self.read(self.parts_of(new)).select(self.key).distinct(), self.key, "left_anti")

    def _write(self, df: DataFrame) -> list[Part]:
        """A run with the rows and its index; its parts."""
        run = uuid.uuid4().hex
        d = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        d = d.withColumns({"_bucket": self.bucket_of(F.col(self.key)), "_slice": F.coalesce(self._slice_of(F.col(self.day)), F.lit(0)) if self.day else F.lit(0)})
        d.repartition(F.col("_bucket"), F.col("_slice")).sortWithinPartitions("_bucket", "_slice", self.key, *([self.day] if self.day else [])).write.partitionBy("_bucket", "_slice").parquet(f"{self.path}/runs/{run}")
        try:
            held = self.spark.read.parquet(f"{self.path}/runs/{run}")
        except PySparkException:  # no rows, so no files to take a schema from
            return []
        n = held.groupBy(self.key, "_bucket", "_slice").agg(F.count("*").alias("n"), F.count_if(F.expr(self.counted)).alias("counted"), (F.max(F.to_date(self.day)) if self.day else F.lit(None).cast("date")).alias("last"))
        n.write.parquet(f"{self.path}/index/{run}")
        rows = self.spark.read.parquet(f"{self.path}/index/{run}").groupBy("_bucket", "_slice").agg(F.sum("n").alias("n")).collect()
        return [Part(run, r["_bucket"], r["_slice"], r.n) for r in rows]

    # ------------------------------------------------ commits

    def change(self, append: DataFrame | None = None, replace: DataFrame | None = None, keys: DataFrame | None = None, batch: tuple[str, int] | None = None) -> bool:
        """One commit: rows of ``keys`` (by default of those in ``replace``) give way to ``replace``, and ``append`` is added. False: the batch was already in."""
        base = self.version()
        parts, batches = self.manifest(base)
        if batch is not None:
            if batches.get(batch[0], -1) >= batch[1]:
                return False
            batches[batch[0]] = batch[1]
        if replace is not None:
            keys = (replace if keys is None else keys).select(self.key).distinct()
            touched = {r.b for r in keys.select(self.bucket_of(F.col(self.key)).alias("b")).distinct().collect()}
            old = [p for p in parts if p.bucket in touched]
            rest = self.read(old).join(keys, self.key, "left_anti")
            parts = [p for p in parts if p.bucket not in touched] + self._write(rest.unionByName(replace.select(*self.schema.names)))
        if append is not None:
            parts = parts + self._write(append)
        self._commit(base, parts, batches)
        return True

    def compact(self, most_runs: int = 8) -> None:
        """Buckets with a slice of more than ``most_runs`` parts are written anew as one run."""
        base = self.version()
        parts, batches = self.manifest(base)
        count: dict[tuple[int, int], int] = {}
        for p in parts:
            count[p.bucket, p.slice] = count.get((p.bucket, p.slice), 0) + 1
        many = {b for (b, _), n in count.items() if n > most_runs}
        if many:
            self._commit(base, [p for p in parts if p.bucket not in many] + self._write(self.read([p for p in parts if p.bucket in many])), batches)

    # ------------------------------------------------ tails

    def tail_parts(self, n: int, end: str | None = None) -> list[Part]:
        """The parts that hold the last ``n`` counted rows of every key, up to the day ``end`` if given."""
        parts = self.manifest()[0]
        if not parts:
            return []
        index = self.spark.read.parquet(*[f"{self.path}/index/{r}" for r in sorted({p.run for p in parts})])
        have = index.select("*", F.element_at(F.split(F.input_file_name(), "/"), -2).alias("run"))
        live = self.spark.createDataFrame(parts, "run string, _bucket int, _slice int, rows long").drop("rows")
        have = have.join(F.broadcast(live), ["run", "_bucket", "_slice"])
        sure = F.col("counted") if end is None else F.when(F.col("last") <= F.to_date(F.lit(end)), F.col("counted")).otherwise(0)
        per = have.groupBy(self.key, "_bucket", "_slice").agg(F.sum(sure).alias("sure"))
        newer = F.sum("sure").over(Window.partitionBy(self.key).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1))
        need = {(r["_bucket"], r["_slice"]) for r in per.withColumn("_newer", newer).where(F.coalesce("_newer", F.lit(0)) < n).select("_bucket", "_slice").distinct().collect()}
        last = None if end is None else self.spark.range(1).select(self._slice_of(F.lit(end))).first()[0]
        return [p for p in parts if (p.bucket, p.slice) in need and (last is None or p.slice <= last)]

    def tail(self, n: int, end: str | None = None) -> DataFrame:
        """Rows of the parts that hold the last ``n`` counted rows of every key; the cut to exactly these is the caller's."""
        return self.read(self.tail_parts(n, end))


def sync(store: Store, derived: DataFrame, may_append: DataFrame | None = None) -> DataFrame:
    """Bring the store to the derived series, code by code, and say how: (key, kind) with same, append or rewrite.

    A code whose stored rows are all in ``derived``, null-safe equal, is the same or gets the days after its last stored one appended, if ``may_append`` (key,
    append), where given, allows it; any difference, a stored day that is gone or a new day between them rewrites the code. Codes that ``derived`` lacks stay.
    """
    key, day = store.key, store.day
    values = [c for c in store.schema.names if c not in (key, day)]
    old, new = store.read(), derived.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in store.schema.fields])
    j = new.select(F.struct(key, day).alias("_at"), F.struct(*values).alias("_new")).join(old.select(F.struct(key, day).alias("_at"), F.struct(*values).alias("_old")), "_at", "full").select(f"_at.{key}", f"_at.{day}", "_new", "_old")
    g = j.groupBy(key).agg(F.max(F.when(F.col("_old").isNotNull(), F.col(day))).alias("_last"), F.min(F.when(F.col("_old").isNull(), F.col(day))).alias("_fresh"), F.bool_and(F.col("_old").isNull() | F.col("_new").eqNullSafe(F.col("_old"))).alias("_equal"), F.count("_new").alias("_n"))
    g = g.where("_n > 0")
    g = g.join(may_append.select(key, F.col("append").alias("_may")), key, "left") if may_append is not None else g.withColumn("_may", F.lit(True))
    after = F.col("_last").isNotNull() & (F.col("_fresh") > F.col("_last")) & F.coalesce("_may", F.lit(False))
    kind = F.when(F.col("_equal") & F.col("_fresh").isNull(), "same").when(F.col("_equal") & after, "append").otherwise("rewrite")
    kinds = kept(g.select(key, kind.alias("kind"), "_last"), "kinds")
    tails = new.join(kinds.where("kind = 'append'").select(key, "_last"), key).where(F.col(day) > F.col("_last")).drop("_last")
    n = {r.kind for r in kinds.select("kind").distinct().collect()}
    if n - {"same"}:
        store.change(append=tails if "append" in n else None, replace=new.join(kinds.where("kind = 'rewrite'").select(key), key, "left_semi") if "rewrite" in n else None)
    return kinds.drop("_last")


def merge_batches(store: Store, name: str, merge: Callable[[DataFrame, DataFrame], DataFrame], first_wins: bool = False) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges a stream's batches into the store, each once, however often it is tried.

    ``merge(old, new)`` gives a bucket's rows after the batch; only buckets that the batch has keys of are read and written. ``first_wins``:
    stored rows stay as they are, so what the merge adds is appended.
    """

    def each(batch: DataFrame, number: int) -> None:
        parts, batches = store.manifest()
        if batches.get(name, -1) >= number:
            return
        batch = batch.select(*store.schema.names).persist()
        try:
            touched = {r.b for r in batch.select(store.bucket_of(F.col(store.key)).alias("b")).distinct().collect()}
            old = store.read([p for p in parts if p.bucket in touched])
            if first_wins:
                new = merge(old, batch).join(old.select(store.key).distinct(), store.key, "left_anti")
                store.change(append=new, batch=(name, number))
            else:
                merged = merge(old.join(batch.select(store.key).distinct(), store.key, "left_semi"), batch)
                store.change(replace=merged, keys=batch, batch=(name, number))
        finally:
            batch.unpersist()

    return each
