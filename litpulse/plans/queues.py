"""Queue generation: which repositories to scan, and from which day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litpulse.functions.dates import iso_date

BATCH_SIZE = 50_000
RECENT_DAYS = 14
INACTIVE_RETRY_DAYS = 30
NEVER = dt.date(1970, 1, 1)


def last_scans(tasks: DataFrame, lane: str) -> DataFrame:
    """Last completed scan day of each repository in one lane."""
    return (
        tasks.where((F.col("lane") == lane) & (F.col("status") == "completed"))
        .groupBy("repo_id")
        .agg(F.max("scan_to").alias("last_scan"))
    )


def repos_with_recent_papers(
    edges: DataFrame, papers: DataFrame, day: dt.date, days: int = RECENT_DAYS
) -> DataFrame:
    """Repositories with an added edge to a paper published in ``[day - days, day]``."""
    published = iso_date(F.col("published_date"))
    recent = papers.where(
        published.between(F.lit(day - dt.timedelta(days=days)), F.lit(day))
    ).select("arxiv_id")
    return (
        edges.where("added").join(recent, "arxiv_id", "left_semi").select("repo_id").distinct()
    )


def not_queued(repos: DataFrame, tasks: DataFrame, same_unit: Column, day: dt.date) -> DataFrame:
    """Repositories neither queued for this unit nor failed lately, in one anti join."""
    failed = (F.col("status") == "failed") & (
        F.col("task_date") >= F.lit(day - dt.timedelta(days=INACTIVE_RETRY_DAYS))
    )
    return repos.join(
        tasks.where(same_unit | failed).select("repo_id").distinct(), "repo_id", "left_anti"
    )


def recent_queue(
    repos: DataFrame, edges: DataFrame, papers: DataFrame, tasks: DataFrame, day: dt.date,
    limit: int = BATCH_SIZE,
) -> DataFrame:
    """Scans of one day for repositories with recent papers, newest repositories first."""
    today = F.lit(day)
    unit = (F.col("lane") == "p0") & (F.col("task_date") == today) & (F.col("round_number") == 0)
    due = not_queued(repos.where(F.col("created") <= today), tasks, unit, day).join(
        repos_with_recent_papers(edges, papers, day), "repo_id", "left_semi"
    )
    start = F.coalesce(F.date_add("last_scan", 1), F.least("created", today), today)
    return (
        due.join(last_scans(tasks, "p0"), "repo_id", "left")
        .orderBy(F.col("created").desc_nulls_last(), "repo_id")
        .limit(limit)
        .select(
            F.lit("p0").alias("lane"), today.alias("task_date"), F.lit(0).alias("round_number"),
            "repo_id", "full_name", start.alias("scan_start"), today.alias("scan_to"),
        )
    )


def round_queue(
    repos: DataFrame, tasks: DataFrame, round_number: int, snapshot: dt.date, limit: int = BATCH_SIZE
) -> DataFrame:
    """Scans of one full round, longest unscanned first; an unknown creation day is allowed."""
    today = F.lit(snapshot)
    unit = (F.col("lane") == "p2") & (F.col("round_number") == round_number)
    known = repos.where(F.col("created").isNull() | (F.col("created") <= today))
    scanned = not_queued(known, tasks, unit, snapshot).join(last_scans(tasks, "p2"), "repo_id", "left")
    behind = F.coalesce("last_scan", F.date_sub("created", 1), F.date_sub(today, 1)) < today
    start = F.coalesce(F.date_add("last_scan", 1), F.col("created"), today)
    return (
        scanned.where(behind)
        .orderBy(
            F.coalesce("last_scan", F.lit(NEVER)).asc(), F.col("created").desc_nulls_last(), "repo_id"
        )
        .limit(limit)
        .select(
            F.lit("p2").alias("lane"), today.alias("task_date"),
            F.lit(round_number).alias("round_number"), "repo_id", "full_name",
            start.alias("scan_start"), today.alias("scan_to"),
        )
    )
