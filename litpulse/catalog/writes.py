"""Registered queries: archive, merges, sinks and lossless partitioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from litpulse.catalog.bindings import (
    EDGES, EVENTS, PAPERS, SNAP, as_id, edges, events, papers, parse_input, repos, table, with_,
)
from litpulse.catalog.rankings import (
    ACTIVITY, BOUND, CITATION, LISTED, REPO_JSON, cdetails, cranking, json_list, ranking, stored_lists, stored_ranking,
)
from litpulse.catalog.registry import query
from litpulse.operators import merge
from litpulse.plans import activity, release_dates
from litpulse.session import materialise, scratch_path
from litpulse.sources import jsonl, sinks, tables
from litpulse.streaming import ingest as streams

ARCHIVE = "arxiv_id string, title string, published_date string"


def _archive_rows(spark, sf):
    return papers(spark, sf).select("arxiv_id", "title", "published_date", F.lit(1).alias("seq"))


@query(
    "archive_roundtrip",
    with_(PAPERS)
    + """SELECT arxiv_id, title, published_date, left(published_date, 4) AS published_year,
      substr(published_date, 6, 2) AS month FROM papers""",
)
def _(spark, sf):
    path = jsonl.archive_path(scratch_path(spark, "archive"))
    rows = _archive_rows(spark, sf)
    undated = rows.withColumns({"published_date": F.lit(""), "arxiv_id": F.concat(F.lit("u"), "arxiv_id")})
    jsonl.upsert_archive(rows.unionByName(undated), path, ARCHIVE, "published_date", "arxiv_id", "seq")
    return jsonl.read_jsonl(spark, path, jsonl.archive_schema(ARCHIVE))


@query(
    "archive_upsert",
    with_(PAPERS)
    + """SELECT arxiv_id, CASE WHEN published_date >= '2000' THEN 'new ' || title ELSE title END AS title,
      published_date, left(published_date, 4) AS published_year, substr(published_date, 6, 2) AS month FROM papers""",
)
def _(spark, sf):
    path = jsonl.archive_path(scratch_path(spark, "archive"))
    rows = _archive_rows(spark, sf)
    jsonl.upsert_archive(rows, path, ARCHIVE, "published_date", "arxiv_id", "seq")
    # Two newer versions of the later papers: the highest sequence wins.
    late = rows.where("published_date >= '2000'")
    batch = late.withColumns({"title": F.lit("older"), "seq": F.lit(2)}).unionByName(
        late.withColumns({"title": F.concat(F.lit("new "), "title"), "seq": F.lit(3)})
    )
    jsonl.upsert_archive(batch, path, ARCHIVE, "published_date", "arxiv_id", "seq")
    return jsonl.read_jsonl(spark, path, jsonl.archive_schema(ARCHIVE))


@query(
    "jsonl_overwrite",
    """SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN p_brand END AS brand,
      CAST(DATE '1995-01-01' + p_size AS VARCHAR) AS day FROM part""",
)
def _(spark, sf):
    path = scratch_path(spark, "jsonl")
    rows = table(spark, sf, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("brand"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size")).alias("day"),
    )
    jsonl.write_jsonl(rows, path)
    jsonl.write_jsonl(rows, path)  # a second write replaces the first
    return jsonl.read_jsonl(spark, path, "p_partkey bigint, p_name string, brand string, day string")


@query("absent_archive", "SELECT COUNT(*) * 0 AS n_rows FROM orders")
def _(spark, sf):
    absent = jsonl.read_jsonl(spark, f"{sf}/no_such_archive", ARCHIVE)
    return (
        table(spark, sf, "orders").select(as_id("o_orderkey").alias("arxiv_id"))
        .join(absent, "arxiv_id", "left_semi").agg(F.count("*").alias("n_rows"))
    )


@query(
    "object_listing",
    """SELECT COUNT(DISTINCT strftime(o_orderdate, '%Y-%m')) AS n_partitions, TRUE AS has_bytes FROM orders""",
)
def _(spark, sf):
    path = scratch_path(spark, "listing")
    rows = papers(spark, sf).select("arxiv_id", F.substring("published_date", 1, 7).alias("month"))
    rows.hint("rebalance", "month").write.partitionBy("month").parquet(path)
    stats = tables.output_stats(spark, path, "month")
    return stats.select("n_partitions", ((F.col("n_bytes") > 0) & (F.col("n_files") > 0)).alias("has_bytes"))


@query(
    "merge_papers",
    with_(PAPERS)
    + """SELECT arxiv_id, CASE WHEN categories = 'F' THEN 'second' ELSE title END AS title, published_date
    FROM papers WHERE categories <> 'P' UNION ALL
    SELECT arxiv_id, 'second', published_date FROM papers WHERE categories = 'P'""",
)
def _(spark, sf):
    rows = papers(spark, sf).select("arxiv_id", "title", "published_date", "categories")
    stored = rows.where("categories <> 'P'").drop("categories")
    # Known (F) and unknown (P) papers arrive twice.
    fresh = rows.where("categories <> 'O'").drop("categories")
    batch = fresh.withColumns({"title": F.lit("first"), "landed": F.lit(1)}).unionByName(
        fresh.withColumns({"title": F.lit("second"), "landed": F.lit(2)})
    )
    return merge.merge_papers(stored, batch, "landed")


_MERGED_EVENTS = """SELECT repo_id, metric, date, CASE WHEN date >= DATE '1999-01-01'
      THEN CASE WHEN count % 3 = 0 THEN count ELSE count * 2 END ELSE count END AS count FROM events_long"""


def _event_batch(rows):
    """Two scans of the later days: the second has two pages, which add up, and some zero days."""
    late = rows.where("date >= DATE'1999-01-01'")
    again = late.where("count % 3 <> 0")
    return (
        again.withColumns({"scan": F.lit(2), "page": F.lit(1)})
        .unionByName(again.withColumns({"scan": F.lit(2), "page": F.lit(2)}))
        .unionByName(late.withColumns({"count": F.lit(0).cast("bigint"), "scan": F.lit(3), "page": F.lit(1)}))
        .unionByName(again.withColumns({"count": F.lit(7).cast("bigint"), "scan": F.lit(1), "page": F.lit(1)}))
    )


@query("merge_events", with_(EVENTS) + _MERGED_EVENTS)
def _(spark, sf):
    rows = events(spark, sf)
    return merge.merge_events(rows, _event_batch(rows), "scan")


@query("stream_events", with_(EVENTS) + _MERGED_EVENTS)
def _(spark, sf):
    rows = materialise(events(spark, sf), "days")  # every delivery is made of them
    landing, out, state = (scratch_path(spark, n) for n in ("landing", "events", "state"))
    # The stored days land first, the later scans in a second delivery of several batches.
    rows.withColumns({"scan": F.lit(0), "page": F.lit(1)}).write.json(landing, compression="gzip")
    streams.stream_events(spark, landing, out, state)
    # Files of about one size: the second pages of a scan in other files than the first, each file a stretch of days,
    # so that a batch touches few months.
    _event_batch(rows).repartitionByRange(8, "page", "date", "scan").write.mode("append").json(landing, compression="gzip")
    streams.stream_events(spark, landing, out, state, files_per_batch=2)
    return merge.daily_counts(streams.events_table(spark, out).read())


@query(
    "merge_repos",
    """SELECT p_partkey AS repo_id, CASE WHEN p_partkey % 2 = 0 THEN 'new/' || p_name ELSE p_brand || '/' || p_name END AS full_name,
      CASE WHEN p_partkey % 2 = 0 THEN 'new' ELSE p_brand END AS owner, p_name AS name,
      CASE WHEN p_partkey % 97 <> 0 THEN DATE '1995-01-01' + CAST(p_partkey % 2500 AS INTEGER)
           WHEN p_partkey % 2 = 0 THEN DATE '2005-01-01' END AS created
    FROM part WHERE p_partkey % 5 <> 0 OR p_partkey % 2 = 1
    UNION ALL SELECT p_partkey, 'new/' || p_name, 'new', p_name, DATE '2005-01-01' FROM part
      WHERE p_partkey % 5 = 0 AND p_partkey % 2 = 0""",
)
def _(spark, sf):
    rows = repos(spark, sf)
    stored = rows.where("repo_id % 5 <> 0 OR repo_id % 2 = 1")
    even = rows.where("repo_id % 2 = 0").withColumns(
        {"owner": F.lit("new"), "full_name": F.concat(F.lit("new/"), "name"), "created": F.lit("2005-01-01").cast("date")}
    )
    batch = even.withColumns({"owner": F.lit("old"), "created": F.lit(None).cast("date"), "seq": F.lit(1)}).unionByName(
        even.withColumn("seq", F.lit(2))
    )
    return merge.merge_repos(stored, batch, "seq")


_FOUND = """found AS (SELECT DISTINCT repo_id, arxiv_id FROM edges WHERE repo_id % 3 = 0
  UNION SELECT DISTINCT repo_id + 1000000, CASE WHEN repo_id % 2 = 0 THEN arxiv_id ELSE 'x' || arxiv_id END FROM edges WHERE repo_id % 7 = 0)"""


def _found_pairs(spark, sf):
    pairs = edges(spark, sf).select("repo_id", "arxiv_id")
    other = F.when(F.col("repo_id") % 2 == 0, F.col("arxiv_id")).otherwise(F.concat(F.lit("x"), "arxiv_id"))
    new = pairs.where("repo_id % 7 = 0").select((F.col("repo_id") + 1000000).alias("repo_id"), other.alias("arxiv_id"))
    # Large tables hold some of the new ids; a pair of theirs is not found anew.
    new = new.join(pairs.where("repo_id >= 1000000"), ["repo_id", "arxiv_id"], "left_anti")
    return pairs.where("repo_id % 3 = 0").unionByName(new)


def _edge_sql(date: str) -> str:
    return (
        with_(EDGES, PAPERS, _FOUND)
        + f"""SELECT e.repo_id, e.arxiv_id, e.added OR e.repo_id % 3 = 0 AS added, e.date FROM edges e
    UNION ALL SELECT f.repo_id, f.arxiv_id, TRUE, {date} FROM found f
    LEFT JOIN papers p ON p.arxiv_id = f.arxiv_id
    WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.repo_id = f.repo_id AND e.arxiv_id = f.arxiv_id)"""
    )


@query("merge_edges", _edge_sql(f"COALESCE(p.paper_date, DATE '{SNAP}')"))
def _(spark, sf):
    return merge.merge_edges(edges(spark, sf), _found_pairs(spark, sf), papers(spark, sf), SNAP)


@query("merge_edges_without_papers", _edge_sql(f"DATE '{SNAP}'"))
def _(spark, sf):
    return merge.merge_edges(edges(spark, sf), _found_pairs(spark, sf), None, SNAP)


@query(
    "replace_version",
    """SELECT o_orderkey, o_orderstatus AS version, CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 ELSE o_custkey END AS v
    FROM orders""",
)
def _(spark, sf):
    path = scratch_path(spark, "versions")
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("version"), F.col("o_custkey").alias("v"))
    sinks.replace_version(rows, path, "version")
    sinks.replace_version(rows.where("version = 'F'").withColumn("v", F.col("v") + 1), path, "version")
    return spark.read.parquet(path)


@query(
    "snapshot_read",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'""",
)
def _(spark, sf):
    path = scratch_path(spark, "versions")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.replace_version(rows, path, "o_orderstatus")
    return tables.read_snapshot(spark, path, "o_orderstatus", "F").select("o_orderkey", "o_custkey")


@query("overwrite_snapshot", ACTIVITY + "SELECT window_name, metric, rank, arxiv_id FROM ranking")
def _(spark, sf):
    path = scratch_path(spark, "snapshot")
    rows = ranking(spark, sf).select("window_name", "metric", "rank", "arxiv_id")
    sinks.overwrite_snapshot(rows.limit(0), path)
    sinks.overwrite_snapshot(rows, path)  # the earlier snapshot is gone
    return spark.read.parquet(path)


@query("export_ranking", ACTIVITY + "SELECT * FROM ranking")
def _(spark, sf):
    path = scratch_path(spark, "export")
    sinks.export_ranking(ranking(spark, sf), path)
    return spark.read.parquet(path)


@query(
    "export_details",
    ACTIVITY
    + f""", {LISTED}, chunks AS (
      SELECT arxiv_id, COUNT(*) AS n, CAST(to_json(list({REPO_JSON} ORDER BY position)) AS VARCHAR) AS listed
      FROM listed GROUP BY arxiv_id, (position - 1) // 3)
    SELECT arxiv_id, CAST(SUM(n) AS BIGINT) AS repo_count, COUNT(*) AS n_chunks, COUNT(*) AS repo_chunks, CAST(SUM(strlen(listed)) AS BIGINT) AS list_bytes
    FROM chunks GROUP BY arxiv_id""",
)
def _(spark, sf):
    path = scratch_path(spark, "export")
    ranked = stored_ranking(spark, sf)
    lists = stored_lists(spark, sf, ranked)
    details = activity.paper_details(ranked, lists, papers(spark, sf), SNAP, BOUND, size=3)
    sinks.export_details(details, activity.paper_repo_chunks(lists, size=3), path)
    chunks = spark.read.parquet(f"{path}/repo_chunks").select("arxiv_id", json_list(F.col("linked_repos")))
    whole = chunks.groupBy("arxiv_id").agg(F.count("*").alias("n_chunks"), F.sum(F.octet_length("linked_repos")).alias("list_bytes"))
    return spark.read.parquet(f"{path}/details").select("arxiv_id", "repo_count", "repo_chunks").join(whole, "arxiv_id")


@query("export_citations", CITATION + "SELECT arxiv_id, work_id, cited_by_count FROM cdetails")
def _(spark, sf):
    path = scratch_path(spark, "export")
    ranked = materialise(cranking(spark, sf), "citations")
    sinks.export_citations(ranked, cdetails(spark, sf, ranked), path)
    return spark.read.parquet(f"{path}/details").select("arxiv_id", "work_id", "cited_by_count")


# Lossless partitioning by release date.


def _raw_lines(spark, sf):
    """Orders as JSON lines with a version list; every ninth has no usable date."""
    stamp = F.concat(F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    created = F.when(F.col("o_orderkey") % 9 == 4, F.lit("soon")).otherwise(stamp)
    versions = F.array(
        F.struct(F.lit("v1").alias("version"), created.alias("created")),
        F.struct(F.lit("v2").alias("version"), F.lit("Thu, 01 Oct 2026 00:04:04 GMT").alias("created")),
    )
    line = F.to_json(
        F.struct(
            as_id("o_orderkey").alias("paper_id"), F.struct(versions.alias("versions")).alias("metadata"),
            F.col("o_orderpriority").alias("note"),
        )
    )
    orders = parse_input(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    return orders.select(line.alias("raw_json"))


@query(
    "release_date_histogram",
    """SELECT strftime(o_orderdate, '%Y') AS year, COUNT(*) AS n_records FROM orders
    WHERE o_orderkey % 9 <> 4 GROUP BY 1""",
)
def _(spark, sf):
    return release_dates.year_histogram(release_dates.with_publish_date(_raw_lines(spark, sf)))


@query(
    "release_date_counts",
    """SELECT COUNT(*) AS total, COUNT(d) AS valid, COUNT(*) - COUNT(d) AS invalid, MIN(d) AS first_date, MAX(d) AS last_date
    FROM (SELECT CASE WHEN o_orderkey % 9 <> 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)""",
)
def _(spark, sf):
    return release_dates.date_counts(release_dates.with_publish_date(_raw_lines(spark, sf)))


def _stored(spark, sf):
    path = scratch_path(spark, "by-date")
    release_dates.write_by_date(release_dates.with_publish_date(_raw_lines(spark, sf)), path)
    return path


@query(
    "partition_by_release_date",
    """SELECT CAST(o_orderkey AS VARCHAR) AS paper_id, strftime(o_orderdate, '%Y-%m-%d') AS publish_date
    FROM orders WHERE o_orderkey % 9 <> 4""",
)
def _(spark, sf):
    rows = release_dates.read_by_date(spark, _stored(spark, sf))
    return rows.select(F.get_json_object("raw_json", "$.paper_id").alias("paper_id"), "publish_date")


@query(
    "release_date_output_stats",
    "SELECT COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS n_partitions FROM orders WHERE o_orderkey % 9 <> 4",
)
def _(spark, sf):
    return tables.output_stats(spark, _stored(spark, sf), "publish_date").select("n_partitions")


@query(
    "lossless_report",
    """WITH c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderkey % 9 = 4) AS bad FROM orders)
    SELECT unnest(['rows', 'ids', 'hashes']) AS layer, n AS n_left, n - bad AS n_right, bad AS only_left,
      CAST(0 AS BIGINT) AS only_right, bad = 0 AS passed FROM c""",
)
def _(spark, sf):
    raw = _raw_lines(spark, sf)
    return release_dates.lossless_report(raw, release_dates.read_by_date(spark, _stored(spark, sf)))


@query(
    "sample_matches",
    """SELECT paper_id, TRUE AS same_hash, TRUE AS same_fields FROM (
      SELECT CAST(o_orderkey AS VARCHAR) AS paper_id,
        '{"paper_id":"' || o_orderkey || '","metadata":{"versions":[{"version":"v1","created":"' ||
        strftime(o_orderdate, '%a, %-d %b %Y %H:%M:%S GMT') ||
        '"},{"version":"v2","created":"Thu, 01 Oct 2026 00:04:04 GMT"}]},"note":"' || o_orderpriority || '"}' AS j
      FROM orders WHERE o_orderkey % 9 <> 4) ORDER BY md5(j) LIMIT 5""",
)
def _(spark, sf):
    raw = _raw_lines(spark, sf)
    return release_dates.sample_matches(raw, release_dates.read_by_date(spark, _stored(spark, sf)))
