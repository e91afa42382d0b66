"""Registration of queries over the derived views, each with its DuckDB statement where there is one."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.order import kept, scratch_path
from .views import TABLES, VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Inputs:
    """The driver tables and derived views of one folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        for table in TABLES:
            if re.search(rf"\b{table}\b", VIEWS[name]):
                getattr(self, table).createOrReplaceTempView(table)
        return self.spark.sql(VIEWS[name])

    def stored(self, name: str) -> DataFrame:
        """A view that is read several times, computed once into the shared folder."""
        return self.keep(getattr(self, name), name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return kept(df, name)

    def scratch(self, name: str) -> str:
        """A new folder that the driver and all executors share."""
        return scratch_path(self.spark, name)

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over driver tables and views; used for inputs, not for operators."""
        for table in TABLES:
            if re.search(rf"\b{table}\b", with_views(text)):
                getattr(self, table).createOrReplaceTempView(table)
        return self.spark.sql(with_views(text))


def with_views(text: str) -> str:
    """The statement with the derived views it names as common table expressions."""
    text = text.strip()
    own = re.findall(r"(\w+)(?:\([^)]*\))? as (?:materialized )?\(\s*(?:select|values)", text, re.I)
    used = [v for v in VIEWS if v not in own and re.search(rf"\b(?:from|join)\s+{v}\b", text, re.I)]
    if not used:
        return text
    views = ", ".join(f"{v} AS ({VIEWS[v]})" for v in used)
    if m := re.match(r"with recursive\s", text, re.I):
        return f"WITH RECURSIVE {views}, {text[m.end() :]}"
    if m := re.match(r"with\s", text, re.I):
        return f"WITH {views}, {text[m.end() :]}"
    return f"WITH {views} {text}"


def query(name: str, oracle: str | None = None) -> Callable:
    def register(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLE_SQL[name] = with_views(oracle)
        return f

    return register
