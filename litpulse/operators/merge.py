"""Keyed merges of a table with a batch of new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litpulse.functions.dates import iso_date


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Catalyst puts a group limit of one row per key in front of the shuffle, so a
    key with very many rows sends only one row per task.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", first).where("__rn = 1").drop("__rn")


def replace_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows whose key is not in the batch, plus the batch (unique by key)."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return kept.select(*new.columns).unionByName(new)


def absent_from(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the old table lacks.

    The old side is first cut to the keys of the batch, so that a small batch is
    broadcast and the large table is scanned without being shuffled.
    """
    known = old.join(new.select(*keys), list(keys), "left_semi").select(*keys)
    return new.join(known, list(keys), "left_anti")


def insert_missing(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows, plus those of the batch whose key is not there yet."""
    fresh = absent_from(old, new, keys)
    return old.unionByName(fresh.select(*old.columns))


def merge_papers(papers: DataFrame, batch: DataFrame, sequence: str) -> DataFrame:
    """Paper upsert: every non-key column comes from the newest record of the batch."""
    fresh = newest_per_key(
        batch.where(F.col("arxiv_id").isNotNull()), ["arxiv_id"], [F.col(sequence).desc()]
    )
    return replace_by_key(papers, fresh.select(*papers.columns), ["arxiv_id"])


def merge_events(events: DataFrame, batch: DataFrame, scan: str) -> DataFrame:
    """Event upsert: only counts above zero are written, and the latest scan wins.

    Several rows of one scan for the same day are pages of it and are added;
    across scans a later one replaces the day, whatever its age.
    """
    day = ["repo_id", "metric", "date"]
    # Pages add up in a partial sum, so a busy day shuffles one row per task and scan.
    scanned = batch.where("count > 0").groupBy(*day, scan).agg(F.sum("count").alias("count"))
    latest = scanned.groupBy(*day).agg(F.max_by("count", scan).alias("count"))
    return replace_by_key(events, latest.select(*events.columns), day)


def merge_event_pages(pages: DataFrame, batch: DataFrame) -> DataFrame:
    """Page-wise event upsert: a page replaces itself, and only a day's latest scan is kept.

    Keeping pages apart makes the result the same for any split of a scan into
    batches and for any repetition of a batch. Rows without a day or a scan go, a page without a number
    replaces none. Rows are dealt out once, by day, which serves both windows.
    """
    day = ["repo_id", "metric", "date"]
    page = [*day, "scan", "page"]
    columns = [*page, "count"]
    both = pages.select(*columns, F.lit(False).alias("__new")).unionByName(batch.where("count > 0").select(*columns, F.lit(True).alias("__new")))
    both = both.dropna(subset=[*day, "scan"]).repartition(*day)
    first = Window.partitionBy(*page).orderBy(F.col("__new").desc(), F.col("count").desc())
    ranked = both.select("*", F.row_number().over(first).alias("__rn"), F.first("__new").over(first).alias("__replaced"))
    ranked = ranked.withColumn("__latest", F.max("scan").over(Window.partitionBy(*day)))
    old = ~F.col("__new") & (F.col("page").isNull() | ~F.col("__replaced"))
    kept = ranked.where((F.col("scan") == F.col("__latest")) & (old | F.col("__new") & (F.col("__rn") == 1)))
    return kept.select(*pages.columns)


def daily_counts(pages: DataFrame) -> DataFrame:
    """The daily event table of page-wise counts."""
    return pages.groupBy("repo_id", "metric", "date").agg(F.sum("count").alias("count"))


def merge_repos(repos: DataFrame, batch: DataFrame, sequence: str) -> DataFrame:
    """Repository upsert: names are replaced, the first known ``created`` stays.

    The stored table only meets the keys of the batch, in a semi and an anti join,
    so a small batch is broadcast and the table is not shuffled.
    """
    # The earliest known creation date in the batch is the one a row-wise upsert keeps.
    known = F.when(F.col("created").isNotNull(), F.col(sequence))
    fresh = batch.groupBy("repo_id").agg(
        F.max_by("full_name", sequence).alias("full_name"),
        F.max_by("owner", sequence).alias("owner"),
        F.max_by("name", sequence).alias("name"),
        F.min_by("created", known).alias("created"),
    )
    known_date = repos.join(fresh.select("repo_id"), "repo_id", "left_semi").select(
        "repo_id", F.col("created").alias("__first")
    )
    merged = fresh.join(known_date, "repo_id", "left").withColumn(
        "created", F.coalesce("__first", "created")
    )
    return replace_by_key(repos, merged.select(*repos.columns), ["repo_id"])


def merge_edges(
    edges: DataFrame, found: DataFrame, papers: DataFrame | None, extracted_on: object
) -> DataFrame:
    """Edge upsert for the (repo_id, arxiv_id) pairs found in README files.

    A known pair gets ``added = true`` and keeps its date. A new pair is dated by
    its paper, else by the day of extraction; without a paper table always by
    the latter.
    """
    pair = ["repo_id", "arxiv_id"]
    found = found.select(*pair).distinct()
    flagged = edges.join(
        found.withColumn("__hit", F.lit(True)), pair, "left"
    ).select(
        *pair,
        F.when(F.col("__hit"), F.lit(True)).otherwise(F.col("added")).alias("added"),
        "date",
    )
    fresh = absent_from(edges, found, pair)
    today = F.lit(extracted_on).cast("date")
    if papers is None:
        dated = fresh.withColumn("date", today)
    else:
        dated = fresh.join(
            papers.select("arxiv_id", iso_date(F.col("published_date")).alias("date")), "arxiv_id", "left"
        ).withColumn("date", F.coalesce("date", today))
    return flagged.unionByName(
        dated.withColumn("added", F.lit(True)).select("repo_id", "arxiv_id", "added", "date")
    )
