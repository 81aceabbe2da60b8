"""Registration of queries and of their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litpulse.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Integers as bigint, so that both engines report the same types."""
    return df.select(
        *(
            F.col(c).cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c)
            for c, t in df.dtypes
        )
    )


def query(name: str, sql: str | None = None):
    """Register a callable ``(spark, sf_dir) -> DataFrame`` under a name."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf: plain(fn(use_utc(spark), sf))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register
