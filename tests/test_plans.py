"""The plans that matter at scale: what is pushed down, limited early, broadcast or split."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from litpulse.catalog import bindings
from litpulse.catalog.rankings import _candidates, cranking, ranking
from litpulse.operators.merge import newest_per_key
from litpulse.plans import activity, citations
from litpulse.sources import jsonl

SNAP, FIRST = bindings.SNAP, bindings.FIRST_YEAR


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_ranking_limits_before_the_shuffle(spark, sf):
    text = plan(ranking(spark, sf))
    # Top down: the final limit, the exchange, the partial limit.
    final, partial = text.index("500, Final"), text.index("500, Partial")
    assert final < text.index("Exchange hashpartitioning(window_name") < partial
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_ranking_shuffles_once_per_key(spark, sf, no_broadcast):
    text = plan(ranking(spark, sf), final=True).split("== Initial Plan ==")[0]
    keys = re.findall(r"- Exchange hashpartitioning\(([a-z_]+)#\w+(?:, ([a-z_]+)#)?", text)
    # Events by (repository, metric), both join sides by repository, papers by (id, metric), both
    # sides of the recent-id join by id (its distinct needs no other), then only small ones: the
    # value counts, their floors and the top list. The paper table itself is not shuffled.
    assert sorted(a for a, _ in keys) == sorted(
        ["repo_id"] * 3 + ["arxiv_id"] * 3 + ["window_name"] * 3
    )
    # The second read of the paper values starts from the shuffles of the first.
    assert text.count("ReusedExchange") >= 2
    assert text.count("FileScan") == 4  # events, edges, recent papers, titles


def test_scans_read_only_what_is_used(spark, sf):
    text = plan(activity.repo_activity(bindings.event_lines(spark, sf), SNAP, FIRST))
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert {c.split("#")[0] for c in scan.split(",")} == {
        "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate",
    }


def test_recent_papers_filter_is_pushed(spark, tmp_path):
    path = str(tmp_path / "papers")
    spark.range(10).select(
        F.col("id").cast("string").alias("arxiv_id"), F.lit("2001-05-30").alias("published_date")
    ).write.parquet(path)
    text = plan(activity.recent_papers(spark.read.parquet(path), dt.date(2001, 6, 1)))
    assert "GreaterThanOrEqual(published_date,2001-05-19)" in text


def test_citation_candidates_join_without_a_third_shuffle(spark, sf, no_broadcast):
    text = plan(_candidates(spark, sf))
    assert len(re.findall("Exchange hashpartitioning", text)) == 2
    assert "Window" not in text


def test_citation_ranking_has_no_range_join(spark, sf):
    text = plan(cranking(spark, sf))
    assert "NestedLoop" not in text and "Cartesian" not in text and text.count("WindowGroupLimit") >= 2
    found = _candidates(spark, sf)
    by_table = plan(citations.rank_in_windows(found, citations.citation_windows(found, SNAP)))
    # The only nested loop is with one row that holds all windows.
    assert "Cartesian" not in by_table and by_table.count("WindowGroupLimit") >= 2


def test_windows_of_a_table_join_by_equality(spark, sf, no_broadcast):
    found = _candidates(spark, sf)
    text = plan(citations.rank_in_windows(found, citations.citation_windows(found, bindings.SNAP)))
    assert "SortMergeJoin [__node" in text and "NestedLoop" not in text and "CartesianProduct" not in text


def test_newest_per_key_sends_one_row_per_task(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert plan(newest_per_key(df, ["k"], [F.col("id").desc()])).count("WindowGroupLimit") == 2


def test_hot_repository_is_split(spark, no_broadcast):
    """A repository with most of the edges: its join partition is read by several tasks."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        hot = F.when(n % 10 < 7, F.lit(1)).otherwise(n % 500)
        edges = spark.range(0, 60_000, 1, 8).select(hot.alias("repo_id"), (n % 5000).cast("string").alias("arxiv_id"))
        events = spark.range(0, 2000, 1, 4).select(
            (n % 500).alias("repo_id"), F.lit("star").alias("metric"), F.lit(SNAP).alias("date"), n.alias("count")
        )
        df = activity.paper_activity(edges, activity.repo_activity(events, SNAP, FIRST))
        assert "SortMergeJoin(skew=true)" in plan(df, final=True)
        hot_total = sum(i for i in range(2000) if i % 500 == 1)
        assert df.agg(F.min("total")).first()[0] >= 0 and df.where(F.col("total") >= hot_total).count() > 3000
    finally:
        for key in small:
            spark.conf.unset(key)


def test_archive_reads_only_its_months(spark, tmp_path):
    path = str(tmp_path / "archive")
    ddl = "arxiv_id string, published_date string"
    rows = spark.createDataFrame([("1", "2020-01-05"), ("2", "2021-03-05")], ddl)
    jsonl.with_month(rows, "published_date").write.partitionBy(*jsonl.ARCHIVE_PARTITIONS).json(path)
    month = F.concat_ws("-", *jsonl.ARCHIVE_PARTITIONS)
    text = plan(jsonl.read_jsonl(spark, path, jsonl.archive_schema(ddl)).where(month.isin(["2021-03"])))
    assert re.search(r"PartitionFilters: \[[^\]]*concat_ws", text)
