"""Writes of results: snapshots, versions, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litpulse.operators.quality import require_rows


def overwrite_snapshot(df: DataFrame, path: str) -> None:
    """Drop and rebuild a table that keeps one snapshot."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def replace_version(df: DataFrame, path: str, version: str) -> None:
    """Replace the partitions of the versions in ``df``; other versions stay.

    A frame without rows names no version, so it raises instead of leaving the old one in place unnoticed. To
    replace several tables at once, or to remove a version, use a commit of ``Publication``.
    """
    require_rows(version=df)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(version)
        .parquet(path)
    )


def in_rank_order(ranking: DataFrame) -> DataFrame:
    """The ranking, globally ordered by window, metric and rank."""
    return ranking.orderBy("window_name", "metric", "rank")


def export_ranking(ranking: DataFrame, path: str) -> None:
    in_rank_order(ranking).write.mode("overwrite").parquet(path)


def export_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_details(details: DataFrame, chunks: DataFrame, path: str) -> None:
    """Detail rows and the numbered chunks of their repository lists, which together hold every list whole."""
    export_table(details, f"{path}/details")
    chunks.orderBy("arxiv_id", "chunk").write.mode("overwrite").parquet(f"{path}/repo_chunks")


def export_citations(ranking: DataFrame, details: DataFrame, path: str) -> None:
    """Both citation tables below ``path``; nothing is written when one has no rows."""
    require_rows(ranking=ranking, details=details)
    ranking.orderBy("window_name", "rank").write.mode("overwrite").parquet(f"{path}/ranking")
    details.orderBy(F.col("cited_by_count").desc(), "arxiv_id").write.mode("overwrite").parquet(
        f"{path}/details"
    )
