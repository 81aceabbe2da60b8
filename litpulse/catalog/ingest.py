"""Registered queries: sources and landed payloads."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from litpulse.catalog.bindings import SNAP, as_id, parse_input, table
from litpulse.catalog.registry import query
from litpulse.functions.ids import with_paper_ids
from litpulse.session import scratch_path
from litpulse.sources import documents, jsonl, payloads, tables
from litpulse.streaming import ingest as streams

RANGE = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))


def xml_text(c):
    """Text as XML character data."""
    return F.replace(
        F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")
    )


def _cat(*parts):
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def paper_pages(spark, sf):
    """One XML page per order: a live record, or a deleted, bare or undated one, or no records."""
    key, k = as_id("o_orderkey"), F.col("o_orderkey")
    stamp = _cat(F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss"), " GMT")
    head = _cat(
        "<header", F.when(k % 10 == 1, ' status="deleted"').otherwise(""), "><identifier>oai:x:", key,
        "</identifier><datestamp>", F.date_format("o_orderdate", "yyyy-MM-dd"),
        "</datestamp><setSpec>cs</setSpec><setSpec>cs:cs:", F.col("o_orderstatus"), "</setSpec></header>",
    )
    meta = _cat(
        '<metadata><arXivRaw xmlns="http://arxiv.org/OAI/arXivRaw/"><id>', key, "</id><submitter/>",
        '<version version="v2"><date>Thu, 01 Oct 2026 00:04:04 GMT</date><size>7kb</size></version>',
        '<version version="v1"><date>', F.when(k % 13 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(stamp),
        "</date><size>6kb</size><source_type>D</source_type></version><title>  Order &amp; ", key,
        " \n</title><authors>", F.col("o_orderpriority"), "</authors><categories>", F.col("o_orderstatus"),
        "</categories><journal-ref>J ", key, "</journal-ref><abstract>", F.col("o_orderpriority"), " &lt;b&gt;</abstract></arXivRaw></metadata>",
    )
    records = _cat(
        "<ListRecords><record>", head, F.when(k % 11 == 2, "").otherwise(meta), "</record>",
        "<resumptionToken>", F.when(k % 2 == 0, _cat("t", key)).otherwise(""), "</resumptionToken></ListRecords>",
    )
    body = F.when(k % 17 == 3, '<error code="noRecordsMatch">none</error>').otherwise(records)
    page = _cat(
        '<?xml version="1.0" encoding="UTF-8"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">'
        "<responseDate>2026-10-01T00:00:00Z</responseDate>", body, "</OAI-PMH>",
    )
    orders = parse_input(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    return orders.select(k.alias("page_id"), page.alias("value"))


_LIVE = "o_orderkey % 17 <> 3 AND o_orderkey % 10 <> 1 AND o_orderkey % 11 <> 2 AND o_orderkey % 13 <> 0"


@query(
    "paper_pages",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS arxiv_id, 'Order & ' || o_orderkey AS title,
      o_orderpriority || ' <b>' AS abstract, o_orderpriority AS authors, o_orderstatus AS categories,
      'cs,cs:cs:' || o_orderstatus AS set_specs, CAST(NULL AS VARCHAR) AS submitter, 'J ' || o_orderkey AS journal_ref,
      'v2/Thu, 01 Oct 2026 00:04:04 GMT,v1/' || strftime(o_orderdate, '%a, %-d %b %Y %H:%M:%S GMT') AS versions,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS published_date,
      strftime(o_orderdate, '%Y-%m-%d') AS datestamp, 'oai:x:' || o_orderkey AS oai_identifier
    FROM orders WHERE {_LIVE}""",
)
def _(spark, sf):
    rows = payloads.kept_papers(payloads.classified_papers(paper_pages(spark, sf), "value"))
    return rows.select(
        "arxiv_id", "title", "abstract", "authors", "categories",
        F.array_join("set_specs", ",").alias("set_specs"), "submitter", "journal_ref",
        F.array_join(F.transform("versions", lambda v: F.concat_ws("/", v["version"], v["date"])), ",").alias("versions"),
        "published_date", "datestamp", "oai_identifier",
    )


@query(
    "harvest_counters",
    f"""SELECT COUNT(*) FILTER (WHERE o_orderkey % 17 <> 3) AS fetched,
      COUNT(*) FILTER (WHERE {_LIVE}) AS written,
      COUNT(*) FILTER (WHERE o_orderkey % 17 <> 3 AND o_orderkey % 10 = 1) AS deleted,
      COUNT(*) FILTER (WHERE o_orderkey % 17 <> 3 AND o_orderkey % 10 <> 1 AND o_orderkey % 11 = 2) AS parse_fail,
      COUNT(*) FILTER (WHERE o_orderkey % 17 <> 3 AND o_orderkey % 10 <> 1 AND o_orderkey % 11 <> 2
                       AND o_orderkey % 13 = 0) AS date_fail,
      COUNT(*) AS pages FROM orders""",
)
def _(spark, sf):
    pages = paper_pages(spark, sf)
    return payloads.harvest_counters(payloads.classified_papers(pages, "value"), pages)


@query(
    "resumption_tokens",
    """SELECT o_orderkey AS page_id,
      CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 17 <> 3 THEN 't' || o_orderkey END AS next_token FROM orders""",
)
def _(spark, sf):
    return payloads.page_tokens(paper_pages(spark, sf), "value", "page_id")


@query(
    "single_record_fields",
    """SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, trim(text, chr(9) || chr(10) || chr(13) || ' ') AS abstract,
      lang AS title, CAST(2 AS BIGINT) AS n_versions, '2026-10-01' AS update_date FROM documents""",
)
def _(spark, sf):
    doc = as_id("doc_id")
    page = _cat(
        "<OAI-PMH><GetRecord><record><header><identifier>", doc, "</identifier></header><metadata><arXivRaw><id>", doc,
        '</id><version version="v1"><date>a</date></version><version version="v2"><date>b</date></version><title>',
        F.col("lang"), "</title><abstract>", xml_text(F.col("text")),
        "</abstract><update_date>2026-10-01</update_date></arXivRaw></metadata></record></GetRecord></OAI-PMH>",
    )
    docs = parse_input(spark, sf, "documents", "doc_id", "lang", "text")
    pages = docs.select("doc_id", page.alias("value"))
    return payloads.single_record_fields(pages, "value", "doc_id").select(
        "doc_id", "id", "abstract", "title", "n_versions", "update_date"
    )


@query(
    "atom_entries",
    """SELECT doc_id, '2310.' || lpad(CAST(doc_id AS VARCHAR), 5, '0') AS arxiv_id,
      'A title of ' || lang AS title, source || ',' || lang AS authors, CAST(2 AS BIGINT) AS n_authors,
      'cs.LG,' || lang AS categories, 'cs.LG' AS primary_category, CAST(NULL AS VARCHAR) AS doi,
      'http://x/abs/' || doc_id AS abstract_url, 'http://x/pdf/' || doc_id AS pdf_url,
      length(regexp_replace(text, '\\s', '', 'g')) AS n_dense FROM documents""",
)
def _(spark, sf):
    doc, lang = as_id("doc_id"), F.col("lang")
    feed = _cat(
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x/abs/2310.', F.lpad(doc, 5, "0"),
        "v2</id><title>A\n   title of ", lang, "</title><summary>", xml_text(F.col("text")),
        "</summary><author><name> ", F.col("source"), " </name></author><author><name>", lang,
        '</name></author><category term="cs.LG"/><category term="', lang,
        '"/><primary_category term="cs.LG"/><link rel="alternate" type="text/html" href="http://x/abs/', doc,
        '"/><link rel="related" type="application/pdf" href="http://x/pdf/', doc, '"/></entry></feed>',
    )
    docs = parse_input(spark, sf, "documents", "doc_id", "lang", "source", "text")
    feeds = docs.select("doc_id", feed.alias("value"))
    rows = payloads.atom_entries(feeds, "value", "doc_id")
    return rows.select(
        "doc_id", "arxiv_id", "title", F.array_join("authors", ",").alias("authors"), "n_authors",
        F.array_join("categories", ",").alias("categories"), "primary_category", "doi", "abstract_url", "pdf_url",
        F.length(F.regexp_replace("abstract", r"\s", "")).alias("n_dense"),
    )


# Repository discovery.


def search_pages(spark, sf):
    """One search page per part with two items, the second without a usable name."""
    key = F.col("p_partkey")
    created = _cat(F.date_format(F.date_add(F.lit(SNAP), (key % 100).cast("int")), "yyyy-MM-dd"), "T10:00:00Z")
    items = F.array(
        F.struct(key.alias("id"), _cat(" ", F.col("p_brand"), "/", F.col("p_name"), " ").alias("full_name"), created.alias("created_at")),
        F.struct((key + 1).alias("id"), F.col("p_brand").alias("full_name"), created.alias("created_at")),
    )
    return table(spark, sf, "part").select(
        key.alias("page_id"), F.to_json(F.struct(items.alias("items"))).alias("value")
    )


@query(
    "search_items",
    f"""SELECT p_partkey AS repo_id, p_brand || '/' || p_name AS full_name, p_brand AS owner, p_name AS name,
      DATE '{SNAP}' + CAST(p_partkey % 100 AS INTEGER) AS created FROM part
    WHERE p_partkey <> 0""",
)
def _(spark, sf):
    return payloads.repo_rows(payloads.search_items(search_pages(spark, sf), "value"))


@query(
    "search_coverage",
    f"""WITH item AS (SELECT p_partkey // 100 AS page_id, p_partkey FROM part
        WHERE (p_partkey // 100) % 2 = 0 OR p_partkey % 100 <> 99),
    page AS (SELECT page_id, COUNT(*) AS n, MAX(p_partkey) + 1 AS following, page_id % 7 = 5 AS bad,
        COUNT(*) >= 100 AND MAX(p_partkey) + 1 < 1500 AS more FROM item GROUP BY page_id)
    SELECT page_id, CASE WHEN bad THEN 0 ELSE n END AS n_items,
      CASE WHEN more AND NOT bad THEN strftime(TIMESTAMP '{SNAP} 00:00:00' + to_seconds(following), '%Y-%m-%d %H:%M:%S') END AS next_cursor,
      NOT more AND NOT bad AS hour_finished, CASE WHEN bad THEN 'broken page' END AS error FROM page""",
)
def _(spark, sf):
    # Pages of at most 100 items, as the source sends them; every other page is one short, some are
    # cut off in transit, and the range searched ends after 1500 seconds.
    key = F.col("p_partkey")
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(f"{SNAP} 00:00:00").cast("timestamp")) + key)
    item = F.struct(
        key.alias("id"), F.col("p_name").alias("full_name"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    )
    pages = (
        table(spark, sf, "part")
        .where("(p_partkey div 100) % 2 = 0 OR p_partkey % 100 <> 99")
        .groupBy(F.expr("p_partkey div 100").alias("page_id"))
        .agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("items"))).alias("value"))
    )
    cut = F.expr("substring(value, 1, length(value) - 5)")
    pages = pages.withColumn("value", F.when(F.col("page_id") % 7 == 5, cut).otherwise(F.col("value")))
    end = F.lit(f"{SNAP} 00:25:00").cast("timestamp")
    rows = payloads.search_coverage(pages, "value", "page_id", hour_end=end)
    return rows.withColumn("next_cursor", F.date_format("next_cursor", "yyyy-MM-dd HH:mm:ss"))


@query(
    "readme_join",
    """SELECT p_partkey AS repo_id, d.text IS NULL AS no_readme, COALESCE(length(d.text), 0) AS n_chars
    FROM part LEFT JOIN documents d ON d.doc_id = p_partkey""",
)
def _(spark, sf):
    repos = table(spark, sf, "part").select(
        F.col("p_partkey").alias("repo_id"), _cat("o/", as_id("p_partkey")).alias("full_name")
    )
    readmes = table(spark, sf, "documents").select(
        _cat("o/", as_id("doc_id")).alias("full_name"), F.col("text").alias("readme")
    )
    joined = payloads.repos_with_readme(repos, readmes)
    return joined.select(
        "repo_id", F.col("readme").isNull().alias("no_readme"),
        F.coalesce(F.length("readme"), F.lit(0)).alias("n_chars"),
    )


@query("readmes_without_ids", "SELECT COUNT(*) AS n_texts, CAST(0 AS BIGINT) AS n_ids FROM conversations")
def _(spark, sf):
    found = with_paper_ids(table(spark, sf, "conversations"), "text")
    return found.agg(F.count("*").alias("n_texts"), F.sum(F.size("ids")).alias("n_ids"))


# Daily activity.


def star_pages(spark, sf):
    """One weekly page per line item; half of them wrapped in an object."""
    day = F.to_date("l_shipdate")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    # The week starts two days before the ship date, so the quantity is in slot 2.
    week = F.unix_timestamp(F.date_sub(day, 2).cast("timestamp")).cast("string")
    weeks = _cat('[{"week":', week, ',"days":[0,null,', qty, ',"x",-1,0,0,99]},{"week":null,"days":[5]}]')
    page = F.when(F.col("l_linenumber") % 2 == 0, _cat(' {"weeks":', weeks, "}")).otherwise(weeks)
    lines = parse_input(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_linenumber", "l_shipdate")
    return lines.select(
        F.col("l_partkey").alias("repo_id"), F.lit(RANGE[0]).alias("scan_start"), F.lit(RANGE[1]).alias("scan_to"),
        page.alias("payload"),
    )


@query(
    "daily_star_counts",
    """SELECT l_partkey AS repo_id, CAST(l_shipdate AS DATE) AS date, CAST(SUM(l_quantity) AS BIGINT) AS count
    FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY 1, 2""",
)
def _(spark, sf):
    return payloads.daily_star_counts(star_pages(spark, sf), "payload", "repo_id")


@query(
    "star_page_coverage",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS page_no, l_linenumber % 3 <> 0 AND l_orderkey % 11 > 1 AS complete,
      CASE WHEN l_linenumber % 3 = 0 AND l_linenumber <> 6 AND l_orderkey % 11 > 1 THEN l_linenumber + 1 END AS next_page,
      CASE WHEN l_orderkey % 11 = 0 THEN 'null page' WHEN l_orderkey % 11 = 1 THEN 'broken page'
           WHEN l_linenumber = 6 THEN 'page limit' END AS error FROM lineitem""",
)
def _(spark, sf):
    # Thirty weeks on every third line; line 6 stands for page 100; some orders have null or broken pages.
    start = F.unix_timestamp(F.to_date("l_shipdate").cast("timestamp"))
    n = F.when(F.col("l_linenumber") % 3 == 0, 30).otherwise(29)
    weeks = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.struct((start + i * 604800).cast("string").alias("week"))
    )
    lines = parse_input(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    pages = lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.to_date("l_shipdate").alias("scan_start"),
        F.when(F.col("l_linenumber") == 6, 100).otherwise(F.col("l_linenumber")).alias("page_no"),
        F.when(F.col("l_orderkey") % 11 == 0, F.lit("null")).when(F.col("l_orderkey") % 11 == 1, F.lit("<html>"))
        .otherwise(F.to_json(weeks)).alias("payload"),
    )
    rows = payloads.star_coverage(pages, "payload", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return rows.drop("page_no").withColumnRenamed("l_linenumber", "page_no")


def connection_pages(spark, sf):
    """One connection page per order: its own date, a date long before, and a bad one."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey")
    page = _cat(
        '{"pageInfo":{"hasNextPage":', F.when(key % 2 == 0, "true").otherwise("false"), ',"endCursor":',
        F.when(key % 3 == 0, "null").otherwise('"c"'), '},"nodes":[{"createdAt":"', day,
        'T10:00:00Z"},null,{"createdAt":null},{"createdAt":"bad"}', F.when(key % 5 == 0, ',{"createdAt":"1990-06-01T10:00:00Z"}').otherwise(""), "]}",
    )
    orders = parse_input(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return orders.select(
        key.alias("page_id"), F.col("o_custkey").alias("repo_id"), F.lit(RANGE[0]).alias("scan_start"),
        F.lit(RANGE[1]).alias("scan_to"), F.lit(1).alias("page_no"), page.alias("payload"),
    )


@query(
    "daily_connection_counts",
    """SELECT o_custkey AS repo_id, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS count FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY 1, 2""",
)
def _(spark, sf):
    return payloads.daily_connection_counts(connection_pages(spark, sf), "payload", "repo_id")


@query(
    "connection_page_summary",
    """SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 5 = 0 THEN DATE '1990-06-01'
      ELSE CAST(o_orderdate AS DATE) END AS oldest, o_orderkey % 2 = 0 AS has_next,
      CASE WHEN o_orderkey % 3 <> 0 THEN 'c' END AS end_cursor FROM orders""",
)
def _(spark, sf):
    return payloads.connection_page_summary(connection_pages(spark, sf), "payload", "page_id")


@query(
    "connection_page_coverage",
    """WITH m AS (SELECT *, o_orderkey % 13 <= 1 AS bad, o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0
        AND CAST(o_orderdate AS DATE) > DATE '1996-01-01' AS more FROM orders)
    SELECT o_orderkey AS page_id, CAST(1 AS BIGINT) AS page_no, NOT more AND NOT bad AS complete,
      CASE WHEN more AND NOT bad AND o_orderkey % 3 <> 0 THEN CAST(2 AS BIGINT) END AS next_page,
      CASE WHEN o_orderkey % 13 = 0 THEN 'null page' WHEN bad THEN 'broken page'
           WHEN more AND o_orderkey % 3 = 0 THEN 'missing cursor' END AS error FROM m""",
)
def _(spark, sf):
    # Some connections are absent, some are cut off in transit.
    cut = F.expr("substring(payload, 1, length(payload) - 3)")
    key = F.col("page_id")
    page = F.when(key % 13 == 0, F.lit(None)).when(key % 13 == 1, cut).otherwise(F.col("payload"))
    pages = connection_pages(spark, sf).withColumn("payload", page)
    return payloads.connection_coverage(pages, "payload", "page_id")


# Tables.


@query(
    "fact_table_scan",
    "SELECT l_orderkey, l_partkey, CAST(l_quantity AS BIGINT) AS q, l_returnflag FROM lineitem",
)
def _(spark, sf):
    names = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]
    rows = tables.read_table(spark, f"{sf}/lineitem.parquet", names)
    return rows.select("l_orderkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("q"), "l_returnflag")


@query(
    "optional_table",
    "SELECT (SELECT COUNT(*) FROM customer) AS n_present, CAST(0 AS BIGINT) AS n_absent",
)
def _(spark, sf):
    schema = "c_custkey bigint, c_name string"
    present = tables.read_optional(spark, f"{sf}/customer.parquet", schema)
    absent = tables.read_optional(spark, f"{sf}/not_published.parquet", schema)
    return tables.side_by_side(
        [present.agg(F.count("*").alias("n_present")), absent.agg(F.count("*").alias("n_absent"))]
    )


@query(
    "latest_snapshot",
    """SELECT event_id, user_id FROM events
    WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)""",
)
def _(spark, sf):
    dated = table(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))
    return tables.latest_snapshot(dated, "snapshot_date").select("event_id", "user_id")


@query(
    "deep_offset_page",
    """SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey
    LIMIT 500 OFFSET (SELECT COUNT(*) // 2 FROM orders)""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    # A low ``small`` makes the range narrowing take part at every scale.
    return tables.page_by_offset(rows, "o_orderkey", rows.count() // 2, 500, slices=64, small=100)


@query(
    "batched_read",
    "SELECT lang, COUNT(*) AS n_docs, CAST(SUM(length(text)) AS BIGINT) AS n_chars, TRUE AS small FROM documents GROUP BY lang",
)
def _(spark, sf):
    def work(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": batch["lang"], "n": batch["text"].str.len(), "size": len(batch)})

    docs = table(spark, sf, "documents").select("lang", "text")
    rows = documents.in_batches(docs, 5, work, "lang string, n long, size long")
    return rows.groupBy("lang").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n_chars"), (F.max("size") <= 5).alias("small")
    )


@query(
    "document_profile",
    """SELECT 'd' || doc_id AS paper_id, source AS title, lang AS categories, CAST(2 AS BIGINT) AS n_authors,
      CAST(1 AS BIGINT) AS n_versions, length(text) AS abstract_chars, CAST(2 AS BIGINT) AS n_sections,
      'Intro,' || lang AS section_names, CAST(1 AS BIGINT) AS n_bib, CAST(0 AS BIGINT) AS n_ref,
      'paper_id,metadata,abstract,sections,bib_entries' AS top_keys
    FROM documents WHERE doc_id % 7 <> 0""",
)
def _(spark, sf):
    doc = F.to_json(
        F.struct(
            _cat("d", as_id("doc_id")).alias("paper_id"),
            F.struct(
                F.col("source").alias("title"), F.col("lang").alias("categories"),
                F.array(F.array("lang"), F.array("source")).alias("authors_parsed"),
                F.array(F.struct(F.lit("v1").alias("version"))).alias("versions"),
            ).alias("metadata"),
            F.struct(F.col("text").alias("text")).alias("abstract"),
            F.create_map(F.lit("Intro"), F.struct("source"), F.col("lang"), F.struct("source")).alias("sections"),
            F.create_map(F.lit("b0"), F.struct("lang")).alias("bib_entries"),
        )
    )
    raw = F.when(F.col("doc_id") % 7 == 0, F.lit("not json")).otherwise(doc)
    docs = parse_input(spark, sf, "documents", "doc_id", "lang", "source", "text")
    records = docs.select(F.encode(raw, "UTF-8").alias("jsonl"))
    rows = documents.document_profile(records, "jsonl")
    return rows.select(
        "paper_id", "title", "categories", "n_authors", "n_versions", "abstract_chars", "n_sections",
        F.array_join("section_names", ",").alias("section_names"), "n_bib", "n_ref",
        F.array_join("top_keys", ",").alias("top_keys"),
    )


def _landed_events(spark, sf):
    """The events table as landed JSON files."""
    path = scratch_path(spark, "landing")
    rows = table(spark, sf, "events").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    rows.repartition(6, "event_id").write.json(path)
    return path


@query("resumable_read", "SELECT event_type, COUNT(*) AS n_rows FROM events GROUP BY 1")
def _(spark, sf):
    landing, out, state = _landed_events(spark, sf), scratch_path(spark, "read"), scratch_path(spark, "state")
    schema = "event_id bigint, event_type string, day string"

    def append(batch, number):
        # Named by batch, so a repeated batch replaces itself.
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for _ in range(2):  # the second run resumes from the saved position and finds nothing new
        streams.run_available(streams.json_stream(spark, landing, schema, files_per_batch=2), append, state)
    return spark.read.schema(schema).parquet(out).groupBy("event_type").agg(F.count("*").alias("n_rows"))


@query(
    "daily_event_windows",
    "SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS count FROM events GROUP BY 1, 2",
)
def _(spark, sf):
    timed = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.daily_windows(timed, "ts")


# Archive reads.


@query("raw_lines", "SELECT doc_id, md5(text) AS h, length(text) AS n_chars FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "lines")
    docs = table(spark, sf, "documents")
    docs.select(F.to_json(F.struct("doc_id", "text")).alias("value")).write.text(path)
    parsed = F.from_json("raw_json", "doc_id bigint, text string")
    return jsonl.read_lines(spark, path).select(parsed.alias("d")).select(
        "d.doc_id", F.md5("d.text").alias("h"), F.length("d.text").alias("n_chars")
    )


@query(
    "path_profile",
    """WITH r AS (SELECT o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr FROM orders),
    v AS (
      SELECT k, '$' AS path, CASE WHEN k % 31 = 5 THEN 'broken' ELSE 'object' END AS kind, CAST(NULL AS VARCHAR) AS x FROM r
      UNION ALL SELECT k, '$.id', 'bigint', CAST(k AS VARCHAR) FROM r WHERE k % 31 <> 5
      UNION ALL SELECT k, '$.meta', 'object', NULL FROM r WHERE k % 31 <> 5
      UNION ALL SELECT k, '$.meta.status', 'string', st FROM r WHERE k % 31 <> 5
      UNION ALL SELECT k, '$.meta.even', 'boolean', CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END FROM r WHERE k % 31 <> 5
      UNION ALL SELECT k, '$.tags', CASE WHEN k % 3 = 0 THEN 'void' ELSE 'array' END, NULL FROM r WHERE k % 31 <> 5
      UNION ALL SELECT k, '$.tags[]', 'object', NULL FROM (SELECT *, unnest([1, 2]) FROM r) WHERE k % 31 <> 5 AND k % 3 <> 0
      UNION ALL SELECT k, '$.tags[].name', 'string', unnest([pr, st]) FROM r WHERE k % 31 <> 5 AND k % 3 <> 0)
    SELECT path, kind, count(*) AS n_values, count(DISTINCT k) AS n_records, min(length(x)) AS least_chars, max(length(x)) AS most_chars FROM v GROUP BY 1, 2""",
)
def _(spark, sf):
    key = as_id("o_orderkey")
    tags = _cat('[{"name":"', F.col("o_orderpriority"), '"},{"name":"', F.col("o_orderstatus"), '"}]')
    record = _cat(
        '{"id":', key, ',"meta":{"status":"', F.col("o_orderstatus"), '","even":', F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("false"),
        '},"tags":', F.when(F.col("o_orderkey") % 3 == 0, "null").otherwise(tags), "}",
    )
    orders = parse_input(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    raw = orders.select(F.when(F.col("o_orderkey") % 31 == 5, F.lit("{broken")).otherwise(record).alias("raw"))
    return documents.path_profile(raw, "raw")
