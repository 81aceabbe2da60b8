"""Lossless partitioning of raw JSON lines by first publication date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litpulse.functions.dates import parse_lenient_mail_date
from litpulse.functions.once import once
from litpulse.operators.quality import hash_set_difference, key_set_difference
from litpulse.schemas import DATED_RECORD
from litpulse.sources.tables import side_by_side


def with_publish_date(lines: DataFrame) -> DataFrame:
    """``raw_json`` as it is, plus the date of its first listed version, null if unknown."""
    versions = F.from_json("raw_json", DATED_RECORD)["metadata"]["versions"]
    # A column of its own, so that the JSON is parsed once for all uses of the text.
    created = lines.select("raw_json", F.get(versions, F.lit(0))["created"].alias("created"))
    return created.select(
        "raw_json", once(parse_lenient_mail_date(F.col("created"))).alias("publish_date")
    )


def date_counts(dated: DataFrame) -> DataFrame:
    """Totals, valid and invalid dates, first and last date, in one pass."""
    return dated.agg(
        F.count("*").alias("total"),
        F.count("publish_date").alias("valid"),
        F.count_if(F.col("publish_date").isNull()).alias("invalid"),
        F.min("publish_date").alias("first_date"),
        F.max("publish_date").alias("last_date"),
    )


def year_histogram(dated: DataFrame) -> DataFrame:
    """Records per publication year, in order."""
    return (
        dated.where(F.col("publish_date").isNotNull())
        .groupBy(F.substring("publish_date", 1, 4).alias("year"))
        .agg(F.count("*").alias("n_records"))
        .orderBy("year")
    )


def write_by_date(dated: DataFrame, path: str) -> None:
    """Dated records as Parquet, one partition per date, in one pass over the records.

    Records are rebalanced by date: a date beyond the advisory partition size, by what the shuffle has measured,
    is split over several tasks, each with a file of its own. Small blocks are not merged: with thousands of dates the cost lies
    in opening files, not in bytes, and merging would leave too few writers.
    """
    spark, merging = dated.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merging)
    spark.conf.set(merging, "false")
    try:
        (
            dated.where(F.col("publish_date").isNotNull())
            .select("raw_json", "publish_date")
            .hint("rebalance", "publish_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("publish_date")
            .parquet(path)
        )
    finally:
        spark.conf.set(merging, before)


def read_by_date(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("raw_json string, publish_date string").parquet(path)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A fixed sample: the n rows with the lowest content hash."""
    return df.orderBy(F.md5("raw_json"), "raw_json").limit(n)


def sample_matches(raw: DataFrame, stored: DataFrame, n: int = 5) -> DataFrame:
    """Sampled rows looked up in the raw lines by paper id, with hash and field comparison."""
    pid = F.get_json_object("raw_json", "$.paper_id")
    sample = sample_rows(stored.select("raw_json"), n).select(
        pid.alias("paper_id"), F.col("raw_json").alias("stored_json")
    )
    # Only the sampled lines leave the scan: n rows are broadcast to it.
    hit = raw.select(pid.alias("paper_id"), "raw_json").join(F.broadcast(sample.select("paper_id").distinct()), "paper_id")
    hit = sample.join(hit, "paper_id", "left")
    a, b = F.json_object_keys("raw_json"), F.json_object_keys("stored_json")
    return hit.groupBy("paper_id").agg(
        F.bool_or(F.md5("raw_json") == F.md5("stored_json")).alias("same_hash"),
        F.bool_or(
            (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
        ).alias("same_fields"),
    )


def lossless_report(raw: DataFrame, stored: DataFrame) -> DataFrame:
    """Row counts, id sets and content hashes of raw lines and stored records.

    One row per layer: what each side has, what only one side has, and whether the
    layer passes. Lines without a date are not stored, so the first layer fails
    when there are any, which is what it is there to show.
    """
    ids_raw = raw.select(F.get_json_object("raw_json", "$.paper_id").alias("key"))
    ids_stored = stored.select(F.get_json_object("raw_json", "$.paper_id").alias("key"))
    counts = side_by_side(
        [raw.agg(F.count("*").alias("n_left")), stored.agg(F.count("*").alias("n_right"))]
    ).select(
        F.lit("rows").alias("layer"), "n_left", "n_right",
        F.greatest(F.col("n_left") - F.col("n_right"), F.lit(0)).alias("only_left"),
        F.greatest(F.col("n_right") - F.col("n_left"), F.lit(0)).alias("only_right"),
    )
    keys = key_set_difference(ids_raw, ids_stored, "key").withColumn("layer", F.lit("ids"))
    hashes = hash_set_difference(raw, stored, "raw_json").withColumn("layer", F.lit("hashes"))
    cols = ["layer", "n_left", "n_right", "only_left", "only_right"]
    report = counts.select(*cols).unionByName(keys.select(*cols)).unionByName(hashes.select(*cols))
    return report.withColumn(
        "passed", (F.col("only_left") == 0) & (F.col("only_right") == 0)
    )
