"""All queries of the library by name, with DuckDB SQL where the operator can be stated in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import q_bars, q_events, q_indicators, q_quality, q_samples, q_scalars, q_sources  # noqa: F401  (they register their queries)
from .harness import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-sectional traits of all derived bars."""
    return QUERIES["w16_traits"](spark, sf_dir)
