"""Top-k per group, ranks and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Above this many rows a bounded result is no longer broadcast by hint.
BROADCAST_ROWS = 500_000


def hint_bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a narrow result known to have at most ``rows`` rows.

    Beyond the bound the planner decides from its own size estimates.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """Rows ranked 1..k per group in column ``rank``.

    Catalyst turns rank filter and window into a group limit ahead of the
    shuffle (for k up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000):
    each task passes on at most k rows of a group, however large the group is.
    """
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def value_floor(df: DataFrame, groups: Sequence[str], value: str, k: int | Column, weight: Column | None = None) -> DataFrame:
    """Per group the lowest value that a row among the k highest can have, as ``__floor``; a row counts for ``weight``, else for one.

    ``__reached`` is what the rows down to there count for, less than k if there are no more.
    """
    n = F.count("*") if weight is None else F.sum(weight)
    counts = df.groupBy(*groups, value).agg(n.alias("__n"))
    higher = F.sum("__n").over(Window.partitionBy(*groups).orderBy(F.col(value).desc())) - F.col("__n")
    return (
        counts.withColumn("__higher", higher)
        .where(F.col("__higher") < k)
        .groupBy(*groups)
        .agg(F.min(value).alias("__floor"), F.max(F.col("__higher") + F.col("__n")).alias("__reached"))
    )


def top_k_few_groups(
    df: DataFrame, groups: Sequence[str], value: str, order: Sequence[Column], k: int
) -> DataFrame:
    """``top_k`` by a descending ``value`` for a known small number of groups.

    Counting rows per value needs no sort and shuffles one row per distinct value.
    Rows below the floor that follows from it cannot rank, so the sort sees little
    more than k rows per group instead of everything. The input is read twice; it
    should end in a shuffle, which both reads share.
    """
    floor = F.broadcast(value_floor(df, groups, value, k).drop("__reached"))  # one row per group
    high = df.join(floor, list(groups)).where(F.col(value) >= F.col("__floor")).drop("__floor")
    return top_k(high, groups, [F.col(value).desc(), *order], k)


def unpivot_windows(df: DataFrame, keys: Sequence[str], windows: Mapping[str, str]) -> DataFrame:
    """Columns to rows: ``windows`` maps a window name to its column.

    Only values above zero are kept; nulls go with them. Expansion and filter run
    in one generated stage, so the dropped rows are never materialised.
    """
    values = [F.col(c).alias(name) for name, c in windows.items()]
    return df.unpivot(list(keys), values, "window_name", "metric_value").where("metric_value > 0")


def pivot_metrics(df: DataFrame, keys: Sequence[str], value: str, metrics: Sequence[str]) -> DataFrame:
    """Rows to one column per metric, the highest value each; an absent metric is null."""
    return df.groupBy(*keys).agg(
        *(F.max(F.when(F.col("metric") == m, F.col(value))).alias(m) for m in metrics)
    )
