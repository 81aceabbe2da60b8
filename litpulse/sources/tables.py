"""Table reads: fact tables, parameterised snapshots, optional inputs, paging."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _is_absent(exc: AnalysisException) -> bool:
    return exc.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A Parquet fact table; the columns a query does not use are never read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, split_column: str, low, high, parts: int, **options: str
) -> DataFrame:
    """A live database table, read in ``parts`` ranges of ``split_column``."""
    return spark.read.jdbc(
        url, table, column=split_column, lowerBound=low, upperBound=high,
        numPartitions=parts, properties=options,
    )


def read_snapshot(spark: SparkSession, path: str, partition: str, value: object) -> DataFrame:
    """One snapshot of a partitioned result; other partitions are not listed or read."""
    return spark.read.parquet(path).where(F.col(partition) == F.lit(value))


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet input that may not have been published yet: absent means empty.

    Only absence counts as empty; a damaged or unreadable input still fails.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if not _is_absent(exc):
            raise
        return spark.createDataFrame([], schema)


def latest_snapshot(df: DataFrame, version: str) -> DataFrame:
    """Rows of the highest version, null versions left out; none has no rows.

    The version is found first, so that the filter is a literal that prunes partitions.
    """
    top = df.agg(F.max(version)).first()[0]
    return df.where(F.lit(False)) if top is None else df.where(F.col(version) == F.lit(top))


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every object under a prefix; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("n_bytes"))
    )


def output_stats(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """Number of partitions, files and bytes of a partitioned output."""
    name = F.regexp_extract("path", rf"{partition}=([^/]+)/", 1)
    return (
        list_objects(spark, path)
        .where(F.col("path").endswith(".parquet"))
        .agg(
            F.countDistinct(name).alias("n_partitions"),
            F.count("*").alias("n_files"),
            F.sum("n_bytes").alias("n_bytes"),
        )
    )


def page_by_offset(
    df: DataFrame, key: str, skip: int, size: int, slices: int = 1024, small: int = 100_000
) -> DataFrame:
    """Rows ``skip .. skip+size`` in the order of an integer ``key`` that has no duplicates.

    A plain offset makes one task sort ``skip + size`` rows. Here distributed
    counts per key slice narrow the range until at most ``small`` rows remain to
    be skipped, so a deep page costs a few scans with pushed-down bounds. Rows
    without a key have no place in the order and are on no page.
    """
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return df.limit(0)
    rest = skip
    while rest > small and hi > lo:
        width = max((hi - lo + slices) // slices, 1)
        slice_no = F.expr(f"({key} - {lo}) div {width}")
        counts = (
            df.where(F.col(key).between(lo, hi)).groupBy(slice_no.alias("s")).count()
            .orderBy("s").collect()  # at most ``slices`` rows
        )
        for s, n in counts:
            if rest < n:
                break
            rest -= n
        else:
            return df.limit(0)
        start = lo + s * width
        if width == 1:
            lo = start
            break
        # The page may run past the slice, so only the lower bound is final.
        lo, narrowed = start, min(hi, start + width - 1)
        if rest <= small:
            break
        hi = narrowed
    page = df.where(F.col(key) >= lo).orderBy(key)
    return page.offset(rest).limit(size) if rest else page.limit(size)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def side_by_side(frames: Iterable[DataFrame]) -> DataFrame:
    """One-row frames with different columns as a single row, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))


def tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL of several tables, each with its name in column ``tag``."""
    return union_all(df.withColumn(tag, F.lit(name)) for name, df in frames.items())


def table_is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
