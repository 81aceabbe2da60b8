"""Checks that return what is wrong as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litpulse.schemas import METRICS
from litpulse.sources.tables import side_by_side, union_all

# Allowed window names and task states.
WINDOW_NAME = r"^(rolling_7d|rolling_30d|rolling_3m|rolling_6m|year_ytd|total|d14)$|^year_\d{4}$"
TASK_STATES = ("pending", "running", "completed", "failed")
MAX_RANK = 500


def check_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, counted in one pass. Null counts as passed, as in a CHECK."""
    counts = df.agg(*(F.count_if(~rule).alias(name) for name, rule in rules.items()))
    return counts.select(
        F.inline(
            F.array(
                *(F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules)
            )
        )
    )


def check_key(df: DataFrame, keys: Sequence[str], name: str = "primary_key") -> DataFrame:
    """Keys that are null or occur more than once."""
    absent = F.greatest(*(F.col(k).isNull().cast("int") for k in [*keys, keys[0]]))
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.count_if((F.col("n") > 1) | (absent == 1)).alias("violations")).select(
        F.lit(name).alias("rule"), "violations"
    )


def ranking_violations(ranking: DataFrame, k: int = MAX_RANK) -> DataFrame:
    """The constraints of the activity ranking table."""
    rows = check_rows(
        ranking,
        {
            "window_name": F.col("window_name").rlike(WINDOW_NAME),
            "metric": F.col("metric").isin(*METRICS),
            "rank_range": F.col("rank").between(1, k),
            "not_null": F.col("arxiv_id").isNotNull() & F.col("rank").isNotNull(),
        },
    )
    return rows.unionByName(check_key(ranking, ["snapshot_date", "window_name", "metric", "rank"]))


def citation_violations(ranking: DataFrame, k: int = MAX_RANK) -> DataFrame:
    """The constraints of the citation ranking table."""
    rows = check_rows(
        ranking,
        {
            "rank_range": F.col("rank").between(1, k),
            "cited_not_null": F.col("cited_by_count").isNotNull(),
        },
    )
    return rows.unionByName(check_key(ranking, ["as_of_date", "window_name", "rank"]))


def task_state_violations(tasks: DataFrame, status: str = "status") -> DataFrame:
    return check_rows(tasks, {"status": F.col(status).isin(*TASK_STATES)})


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables, one row each."""
    return union_all(
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    )


def bad_rank_windows(ranking: DataFrame, limit: int = MAX_RANK) -> DataFrame:
    """Windows whose ranks have gaps or that hold more than ``limit`` rows."""
    return (
        ranking.groupBy("window_name")
        .agg(F.count("*").alias("n_rows"), F.max("rank").alias("max_rank"))
        .where((F.col("n_rows") > limit) | (F.col("n_rows") != F.col("max_rank")))
    )


def missing_details(ranking: DataFrame, details: DataFrame) -> DataFrame:
    """Ranked papers without a detail row."""
    return (
        ranking.select("as_of_date", "arxiv_id")
        .distinct()
        .join(details.select("as_of_date", "arxiv_id"), ["as_of_date", "arxiv_id"], "left_anti")
    )


def citation_report(ranking: DataFrame, details: DataFrame, status: Column, k: int = MAX_RANK) -> DataFrame:
    """One row: counts, windows, highest rank, bad windows, missing details, and the verdict."""
    parts = [
        ranking.agg(
            F.count("*").alias("n_ranking"),
            F.countDistinct("window_name").alias("n_windows"),
            F.coalesce(F.max("rank"), F.lit(0)).alias("max_rank"),
        ),
        details.agg(F.count("*").alias("n_details")),
        bad_rank_windows(ranking, k).agg(F.count("*").alias("n_bad_windows")),
        missing_details(ranking, details).agg(F.count("*").alias("n_missing_details")),
    ]
    row = side_by_side(parts)
    passed = (
        (F.col("n_ranking") > 0)
        & (F.col("max_rank") <= k)
        & (F.col("n_bad_windows") == 0)
        & (F.col("n_missing_details") == 0)
        & (status == "completed")
    )
    return row.withColumn("status", status).withColumn("passed", passed)


def require_rows(**tables: DataFrame) -> None:
    """Fail when a table that must have rows has none."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"no rows in {', '.join(empty)}")


def require_contiguous(ranking: DataFrame, k: int = MAX_RANK) -> None:
    """Fail when a window's ranks do not run from 1 to its row count, or go beyond ``k``."""
    bad = bad_rank_windows(ranking, k).count()
    if bad:
        raise ValueError(f"ranks have gaps in {bad} windows")


def require_past(as_of: object, today: object) -> None:
    if as_of is None:
        raise ValueError("the task table holds no date")
    if as_of > today:
        raise ValueError(f"{as_of} is in the future")


def _sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each distinct key with flags for the sides that hold it: one shuffle of combined keys."""
    tagged = left.select(F.col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return tagged.where(F.col("k").isNotNull()).groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r"))


def key_set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of two key sets and of their two differences."""
    return _sides(left, right, key).agg(
        F.count_if(F.col("l") == 1).alias("n_left"),
        F.count_if(F.col("r") == 1).alias("n_right"),
        F.count_if(F.col("r") == 0).alias("only_left"),
        F.count_if(F.col("l") == 0).alias("only_right"),
    )


def key_set_examples(left: DataFrame, right: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The n lowest keys that only one side holds."""
    sides = _sides(left, right, key)
    only_left = sides.where("r = 0").orderBy("k").limit(n).select(F.lit("left").alias("side"), F.col("k").alias("key"))
    only_right = sides.where("l = 0").orderBy("k").limit(n).select(F.lit("right").alias("side"), F.col("k").alias("key"))
    return only_left.unionByName(only_right)


def hash_set_difference(left: DataFrame, right: DataFrame, content: str) -> DataFrame:
    """The same over content hashes."""
    return key_set_difference(
        left.select(F.md5(content).alias("h")), right.select(F.md5(content).alias("h")), "h"
    )


def field_differences(left_json: Column, right_json: Column) -> list[Column]:
    """Top-level field names of two JSON objects: only left, only right, common."""
    a, b = F.json_object_keys(left_json), F.json_object_keys(right_json)
    return [
        F.array_sort(F.array_except(a, b)).alias("only_left"),
        F.array_sort(F.array_except(b, a)).alias("only_right"),
        F.array_sort(F.array_intersect(a, b)).alias("common"),
    ]
