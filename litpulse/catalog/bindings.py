"""The library's tables, bound to the driver's tables.

paper = orders, repository = part, edge, event and work = lineitem. The SQL text
next to each binding builds the same table for the oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAP = dt.date(2001, 6, 1)
FIRST_YEAR = 1995


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def parse_input(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table whose rows are turned into payloads and parsed."""
    return table(spark, sf, name).select(*columns)


def as_id(c: str) -> Column:
    return F.col(c).cast("string")


def papers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        as_id("o_orderkey").alias("arxiv_id"),
        F.col("o_orderpriority").alias("title"),
        F.concat(F.lit("abstract of "), as_id("o_orderkey")).alias("abstract"),
        F.concat(F.lit("author "), as_id("o_custkey")).alias("authors"),
        F.col("o_orderstatus").alias("categories"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("published_date"),
        F.concat(F.lit("10.1/"), as_id("o_orderkey")).alias("doi"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("datestamp"),
    )


PAPERS = """papers AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS arxiv_id, o_orderpriority AS title,
         'abstract of ' || CAST(o_orderkey AS VARCHAR) AS abstract,
         'author ' || CAST(o_custkey AS VARCHAR) AS authors, o_orderstatus AS categories,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS published_date,
         '10.1/' || CAST(o_orderkey AS VARCHAR) AS doi,
         strftime(o_orderdate, '%Y-%m-%d') AS datestamp,
         CAST(o_orderdate AS DATE) AS paper_date
  FROM orders)"""


def metric_of() -> Column:
    return (
        F.when(F.col("l_returnflag") == "A", "star")
        .when(F.col("l_returnflag") == "R", "fork")
        .when(F.col("l_linestatus") == "O", "issue")
        .otherwise("pr")
    )


METRIC_SQL = """CASE WHEN l_returnflag = 'A' THEN 'star' WHEN l_returnflag = 'R' THEN 'fork'
  WHEN l_linestatus = 'O' THEN 'issue' ELSE 'pr' END"""


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events line by line. Activity sums do not need one row per day, so no fold comes first."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("repo_id"),
        metric_of().alias("metric"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("bigint").alias("count"),
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts, unique by repository, metric and day."""
    return (
        event_lines(spark, sf)
        .groupBy("repo_id", "metric", "date")
        .agg(F.sum("count").alias("count"))
    )


EVENTS = f"""events_long AS (
  SELECT l_partkey AS repo_id, {METRIC_SQL} AS metric, CAST(l_shipdate AS DATE) AS date,
         CAST(SUM(l_quantity) AS BIGINT) AS count
  FROM lineitem GROUP BY 1, 2, 3)"""


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges as they come, repeated pairs included."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("repo_id"),
        as_id("l_orderkey").alias("arxiv_id"),
        (F.col("l_linestatus") == "O").alias("added"),
        F.to_date("l_shipdate").alias("date"),
    )


EDGES = """edges AS (
  SELECT l_partkey AS repo_id, CAST(l_orderkey AS VARCHAR) AS arxiv_id,
         (l_linestatus = 'O') AS added, CAST(l_shipdate AS DATE) AS date
  FROM lineitem)"""


def repos(spark: SparkSession, sf: str) -> DataFrame:
    created = F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("p_partkey") % 2500).cast("int"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("repo_id"),
        F.concat("p_brand", F.lit("/"), "p_name").alias("full_name"),
        F.col("p_brand").alias("owner"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_partkey") % 97 != 0, created).alias("created"),
    )


REPOS = """repos AS (
  SELECT p_partkey AS repo_id, p_brand || '/' || p_name AS full_name, p_brand AS owner,
         p_name AS name,
         CASE WHEN p_partkey % 97 <> 0
              THEN DATE '1995-01-01' + CAST(p_partkey % 2500 AS INTEGER) END AS created
  FROM part)"""


def works(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        F.concat(
            F.lit("W"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
            F.lit("-"), as_id("l_partkey"), F.lit("-"), as_id("l_suppkey"),
        ).alias("work_id"),
        as_id("l_orderkey").alias("arxiv_id"),
        F.col("l_quantity").cast("bigint").alias("cited_by_count"),
        F.col("l_linenumber").cast("int").alias("referenced_works_count"),
        F.to_date("l_shipdate").alias("publication_date"),
        F.year("l_shipdate").alias("publication_year"),
        (F.col("l_linestatus") == "O").alias("is_oa"),
        F.col("l_linestatus").alias("oa_status"),
        flag.alias("type"),
        F.lit("en").alias("language"),
        F.col("l_linenumber").cast("int").alias("authors_count"),
        as_id("l_partkey").alias("primary_topic_name"),
        as_id("l_suppkey").alias("primary_topic_field"),
        flag.alias("primary_topic_domain"),
        F.when(flag != "N", flag == "R").alias("is_retracted"),
        F.lit(None).cast("boolean").alias("is_paratext"),
    )


WORKS = """works AS (
  SELECT 'W' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
         || '-' || CAST(l_suppkey AS VARCHAR) AS work_id,
         CAST(l_orderkey AS VARCHAR) AS arxiv_id, CAST(l_quantity AS BIGINT) AS cited_by_count,
         CAST(l_linenumber AS BIGINT) AS referenced_works_count,
         CAST(l_shipdate AS DATE) AS publication_date,
         CAST(year(l_shipdate) AS BIGINT) AS publication_year,
         (l_linestatus = 'O') AS is_oa, l_linestatus AS oa_status, l_returnflag AS type,
         'en' AS language, CAST(l_linenumber AS BIGINT) AS authors_count,
         CAST(l_partkey AS VARCHAR) AS primary_topic_name,
         CAST(l_suppkey AS VARCHAR) AS primary_topic_field, l_returnflag AS primary_topic_domain,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS is_retracted,
         CAST(NULL AS BOOLEAN) AS is_paratext
  FROM lineitem)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
