"""The JSON-lines archive: one record per line, partitioned by publication month."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litpulse.operators.merge import newest_per_key, replace_by_key
from litpulse.session import materialise

ARCHIVE_PARTITIONS = ("published_year", "month")


def archive_path(root: str) -> str:
    """Records of one month lie under ``published_year=YYYY/month=MM`` below this."""
    return f"{root.rstrip('/')}/papers"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines, byte for byte, as ``raw_json``; only a line feed ends a line."""
    return (
        spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("raw_json"))
    )


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed records: blank lines skipped, absent path empty, a bad line fails the job."""
    reader = spark.read.schema(schema).option("lineSep", "\n").option("mode", "FAILFAST")
    try:
        return reader.json(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def archive_schema(schema: str) -> str:
    return ", ".join([schema, *(f"{p} string" for p in ARCHIVE_PARTITIONS)])


def with_month(df: DataFrame, published: str) -> DataFrame:
    """Route rows by the year and month of an ISO date text; shorter text has no place."""
    return df.where(F.length(published) >= 7).withColumns(
        {
            "published_year": F.substring(published, 1, 4),
            "month": F.substring(published, 6, 2),
        }
    )


def write_jsonl(df: DataFrame, path: str) -> None:
    """Overwrite with UTF-8 lines that keep null fields; dates become text."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def upsert_archive(
    batch: DataFrame, path: str, schema: str, published: str, key: str, sequence: str
) -> DataFrame:
    """Merge a batch into the archive and return its rows as written.

    Whole records are replaced, the highest ``sequence`` wins within the batch,
    null or empty keys are dropped. The batch is evaluated once and written to the shared scratch folder. Only the
    months in it are read and rewritten: the list of months, bounded by the calendar, prunes the scan, and
    dynamic partition overwrite leaves the other months alone.
    """
    spark = batch.sparkSession
    fresh = newest_per_key(
        with_month(batch.where(F.col(key) != ""), published),
        [*ARCHIVE_PARTITIONS, key],
        [F.col(sequence).desc()],
    ).select(spark.createDataFrame([], archive_schema(schema)).columns)
    fresh = materialise(fresh, "archive_batch")
    month = F.concat_ws("-", *ARCHIVE_PARTITIONS)
    touched = [r[0] for r in fresh.select(month).distinct().collect()]
    kept = read_jsonl(spark, path, archive_schema(schema)).where(month.isin(touched))
    merged = replace_by_key(
        kept.where(F.col(key) != ""), fresh, [*ARCHIVE_PARTITIONS, key]
    )
    (
        merged.hint("rebalance", *ARCHIVE_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy(*ARCHIVE_PARTITIONS)
        .json(path)
    )
    return fresh
