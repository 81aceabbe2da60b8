"""Registered queries: expressions over text, dates, JSON and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from litpulse.catalog.bindings import EVENTS, as_id, event_lines, events, parse_input, table, with_
from litpulse.catalog.registry import query
from litpulse.functions import dates, jsons, text
from litpulse.functions.ids import paper_id_rows, with_paper_ids
from litpulse.operators import quality
from litpulse.sources import tables
from litpulse.sources.payloads import first_version_date


def _readme_texts(spark, sf):
    """Document texts that end in identifiers of three forms, one of them twice."""
    doc = F.col("doc_id")
    modern = F.concat(F.lit("2310."), F.lpad(as_id("doc_id"), 5, "0"))
    other = F.concat(F.lit("2401."), F.lpad(as_id("doc_id"), 5, "0"))
    old = F.concat(F.lit("hep-th/"), F.lpad(as_id("doc_id"), 7, "0"))
    return parse_input(spark, sf, "documents", "doc_id", "text").select(
        "doc_id",
        F.concat(
            "text",
            F.when(doc % 2 == 0, F.concat(F.lit(" arXiv: "), modern, F.lit("v3"))).otherwise(""),
            F.concat(F.lit("\nhttps://ArXiv.org/abs/"), modern, F.lit("v2 ")),
            F.when(doc % 3 == 0, F.concat(F.lit(" arxiv:"), old)).otherwise(""),
            F.when(doc % 5 == 0, F.concat(F.lit(" eprint = {"), other, F.lit("}"))).otherwise(""),
        ).alias("readme"),
    )


_IDS = """ids AS (
  SELECT doc_id, '2310.' || lpad(CAST(doc_id AS VARCHAR), 5, '0') AS arxiv_id, 'url' AS format FROM documents
  UNION ALL SELECT doc_id, 'hep-th/' || lpad(CAST(doc_id AS VARCHAR), 7, '0'), 'inline' FROM documents WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, '2401.' || lpad(CAST(doc_id AS VARCHAR), 5, '0'), 'bibtex' FROM documents WHERE doc_id % 5 = 0)"""


@query("paper_ids_in_text", with_(_IDS) + "SELECT * FROM ids")
def _(spark, sf):
    return paper_id_rows(_readme_texts(spark, sf), "readme", "doc_id")


@query(
    "paper_ids_as_found",
    with_(_IDS)
    + """SELECT doc_id, string_agg(arxiv_id || ' ' || format, ','
             ORDER BY CASE format WHEN 'url' THEN 1 WHEN 'inline' THEN 2 ELSE 3 END) AS ids
    FROM ids GROUP BY doc_id""",
)
def _(spark, sf):
    found = with_paper_ids(_readme_texts(spark, sf), "readme")
    return found.select(
        "doc_id",
        F.array_join(F.transform("ids", lambda x: F.concat_ws(" ", x["arxiv_id"], x["format"])), ",").alias("ids"),
    )


@query(
    "paper_ids_in_pages",
    r"""SELECT page_id, len(list_distinct(list_concat(
          regexp_extract_all(html, '(?i)arxiv\.org/(?:abs|pdf)/(\d{4}\.\d{4,5}|[a-z][a-z.-]*/\d{7})(?:v\d+)?', 1),
          list_concat(regexp_extract_all(html, '(?i)arXiv[:\s]+(\d{4}\.\d{4,5}|[a-z][a-z.-]*/\d{7})(?:v\d+)?', 1),
          regexp_extract_all(html, '(?i)eprint\s*=\s*[{"''](\d{4}\.\d{4,5}|[a-z][a-z.-]*/\d{7})', 1))))) AS n_ids
    FROM pages""",
)
def _(spark, sf):
    found = with_paper_ids(table(spark, sf, "pages"), "html")
    return found.select("page_id", F.size("ids").alias("n_ids"))


@query(
    "mail_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS strict_date,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS mixed_date
    FROM orders""",
)
def _(spark, sf):
    stamp = F.concat(F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    mixed = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(stamp)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_date(dates.parse_mail_timestamp(stamp)).alias("strict_date"),
        F.to_date(dates.parse_mail_timestamp(mixed)).alias("mixed_date"),
    )


@query(
    "lenient_mail_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS publish_date FROM orders""",
)
def _(spark, sf):
    def form(pattern: str, tail: str = ""):
        return F.concat(F.date_format("o_orderdate", pattern), F.lit(tail))

    key = F.col("o_orderkey") % 5
    stamp = (
        F.when(key == 0, form("EEE, d MMM yyyy HH:mm:ss", " GMT"))
        .when(key == 1, form("d MMM yyyy HH:mm:ss", " +0530"))
        .when(key == 2, form("EEE, dd MMM yy HH:mm", " -0700"))
        .when(key == 3, form("EEE, d MMMM yyyy HH:mm:ss", " EST"))
        .otherwise(form("yyyy-MM-dd"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.parse_lenient_mail_date(stamp).alias("publish_date")
    )


@query(
    "strict_iso_dates",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE)
         WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders""",
)
def _(spark, sf):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey") % 4
    mixed = (
        F.when(key == 0, iso)
        .when(key == 1, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-30")))
        .when(key == 2, F.date_format("o_orderdate", "yyyy-M"))
        .otherwise(F.concat(iso, F.lit("T10:00:00+02:00")))
    )
    return table(spark, sf, "orders").select("o_orderkey", dates.strict_iso_date(mixed).alias("d"))


@query(
    "iso_stamp_dates",
    """SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS written,
       CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS instant_date FROM events""",
)
def _(spark, sf):
    # Every eleventh stamp has an impossible time.
    form = F.when(F.col("event_id") % 11 == 0, F.date_format("ts", "yyyy-MM-dd'T99:99:99Z'"))
    stamp = form.otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, sf, "events").select(
        "event_id",
        dates.iso_timestamp_date(stamp).alias("written"),
        F.to_date(dates.iso_instant(stamp)).alias("instant_date"),
    )


@query("epoch_dates", "SELECT event_id, CAST(ts AS DATE) AS d FROM events")
def _(spark, sf):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", dates.epoch_date(seconds.cast("string")).alias("d"))


@query(
    "date_arithmetic",
    """SELECT o_orderkey, CAST(d - INTERVAL 3 MONTH + INTERVAL 1 DAY AS DATE) AS back_3m,
       CAST(d - INTERVAL 12 MONTH + INTERVAL 1 DAY AS DATE) AS back_12m, d - 13 AS back_13d,
       CAST(date_trunc('year', d) AS DATE) AS year_start, CAST(year(d) AS BIGINT) AS y,
       make_date(year(d), 12, 31) AS year_end, strftime(d, '%Y-%m-%d') AS txt
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _(spark, sf):
    d = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.months_back(d, 3).alias("back_3m"),
        dates.months_back(d, 12).alias("back_12m"),
        F.date_sub(d, 13).alias("back_13d"),
        dates.year_start(d).alias("year_start"),
        F.year(d).alias("y"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("year_end"),
        dates.date_text(d).alias("txt"),
    )


@query(
    "date_range_filter",
    """SELECT l_returnflag, COUNT(*) AS n_rows FROM lineitem
    WHERE l_shipdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY 1""",
)
def _(spark, sf):
    # The literal has the column's own type, so the range reaches the Parquet reader.
    low, high = (F.lit(x).cast("timestamp_ntz") for x in ("1998-01-01", "1998-12-31"))
    rows = table(spark, sf, "lineitem").where(F.col("l_shipdate").between(low, high))
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n_rows"))


@query(
    "null_aware_functions",
    """SELECT o_orderkey, COALESCE(a, o_custkey) AS c, LEAST(a, b) AS l,
       CASE WHEN o_totalprice > 200000 THEN 'high' ELSE 'low' END AS band, 'year_' || year(o_orderdate) AS tag
    FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS a,
                 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS b FROM orders)""",
)
def _(spark, sf):
    a = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))
    b = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.coalesce(a, "o_custkey").alias("c"),
        F.least(a, b).alias("l"),
        F.when(F.col("o_totalprice") > 200000, "high").otherwise("low").alias("band"),
        F.format_string("year_%d", F.year("o_orderdate")).alias("tag"),
    )


@query(
    "text_functions",
    """SELECT doc_id, trim(t, chr(9) || chr(10) || ' ') AS stripped, left(text, 10) AS head,
       split_part(s, '/', 1) AS owner, substr(s, instr(s, '/') + 1) AS name,
       left(text, 500) AS clipped, regexp_matches(text, '[0-9]{4}') AS has_year
    FROM (SELECT doc_id, text, '  ' || chr(10) || text || chr(9) AS t,
                 source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) AS s FROM documents)""",
)
def _(spark, sf):
    padded = F.concat(F.lit("  \n"), "text", F.lit("\t"))
    slug = F.concat_ws("/", "source", "lang", as_id("doc_id"))
    return table(spark, sf, "documents").select(
        "doc_id",
        text.strip(padded).alias("stripped"),
        F.left("text", F.lit(10)).alias("head"),
        text.owner_of(slug).alias("owner"),
        text.name_of(slug).alias("name"),
        text.clip(F.col("text"), 500).alias("clipped"),
        F.col("text").rlike("[0-9]{4}").alias("has_year"),
    )


@query(
    "collapsed_whitespace",
    r"""SELECT doc_id, trim(regexp_replace(text, '[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS t FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.collapse_whitespace(F.col("text")).alias("t"))


@query(
    "missing_values",
    """SELECT doc_id, (trim(x, ' ') = '') IS NOT FALSE AS no_text, n_chars % 3 = 0 AS no_array,
       n_chars % 4 = 0 AS no_number
    FROM (SELECT doc_id, n_chars, CASE WHEN doc_id % 3 = 0 THEN '   ' WHEN doc_id % 3 = 1 THEN NULL ELSE text END AS x
          FROM documents)""",
)
def _(spark, sf):
    n = F.col("n_chars")
    x = F.when(F.col("doc_id") % 3 == 0, F.lit("   ")).when(F.col("doc_id") % 3 == 2, F.col("text"))
    arr = F.when(n % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("lang"))
    number = F.when(n % 4 == 0, F.lit(float("nan"))).otherwise(n.cast("double"))
    return table(spark, sf, "documents").select(
        "doc_id",
        text.is_missing(x, "string").alias("no_text"),
        text.is_missing(arr, "array<string>").alias("no_array"),
        text.is_missing(number, "double").alias("no_number"),
    )


@query("content_hashes", "SELECT doc_id, md5(text) AS h FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))


@query(
    "json_fields",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS parsed_k FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.from_json("props", "k bigint")["k"].alias("parsed_k"),
    )


@query(
    "json_text_with_nulls",
    """SELECT o_orderkey, '{"id":' || o_orderkey || ',"owner":' ||
       CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || '}' AS j,
       CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE '["' || o_orderstatus || '"]' END AS list
    FROM orders""",
)
def _(spark, sf):
    key = F.col("o_orderkey")
    obj = F.struct(key.alias("id"), F.when(key % 3 != 0, F.col("o_orderpriority")).alias("owner"))
    arr = F.filter(F.array("o_orderstatus"), lambda _: key % 2 != 0)
    return table(spark, sf, "orders").select(
        "o_orderkey", jsons.to_json_full(obj).alias("j"), jsons.json_or_null(arr).alias("list")
    )


@query(
    "tolerant_int_arrays",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(SUM(l_quantity) AS BIGINT) AS total, COUNT(*) * 2 AS n_bad
    FROM lineitem GROUP BY ALL""",
)
def _(spark, sf):
    qty = F.col("l_quantity").cast("bigint").cast("string")
    ints = jsons.to_ints(F.array(qty, F.lit("x"), F.lit(None).cast("string")))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return (
        table(spark, sf, "lineitem")
        .select(*keys, F.explode(ints).alias("v"))
        .groupBy(*keys)
        .agg(F.sum("v").alias("total"), F.count_if(F.col("v").isNull()).alias("n_bad"))
    )


@query(
    "linked_repos_from_json",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 0 END AS n,
       CASE WHEN p_partkey % 4 < 2 THEN p_name END AS first_name FROM part""",
)
def _(spark, sf):
    key = F.col("p_partkey")
    repo = F.struct(key.alias("repo_id"), F.col("p_name").alias("full_name"))
    as_text = (
        F.when(key % 4 == 0, F.to_json(F.array(repo)))
        .when(key % 4 == 1, F.concat(F.lit('{"a":'), F.to_json(repo), F.lit("}")))
        .when(key % 4 == 2, F.lit("not json"))
    )
    repos = jsons.linked_repo_array(as_text)
    return table(spark, sf, "part").select(
        "p_partkey", F.size(repos).alias("n"), F.get(repos, F.lit(0))["full_name"].alias("first_name")
    )


@query(
    "first_version_pick",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN 'undated' ELSE
       strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders""",
)
def _(spark, sf):
    def version(name, date):
        return F.struct(F.lit(name).cast("string").alias("version"), date.alias("date"))

    first = F.date_format("o_orderdate", "yyyy-MM-dd")
    late = F.lit("2030-01-01")
    key = F.col("o_orderkey") % 6
    versions = (
        F.when(key == 0, F.filter(F.array(version("v1", late)), lambda _: F.lit(False)))
        .when(key == 1, F.array(version("v1", late), version("draft", F.lit("undated"))))
        .otherwise(F.array(version("v10", late), version("v2", late), version(" v1 ", first)))
    )
    return table(spark, sf, "orders").select("o_orderkey", first_version_date(versions).alias("d"))


@query(
    "year_sequence",
    """SELECT o_orderkey, unnest(range(year(o_orderdate), 1998)) AS y FROM orders""",
)
def _(spark, sf):
    # Orders of 1998 and later have no earlier year: the guarded sequence gives no row.
    first, last = F.year("o_orderdate"), F.lit(1997)
    years = F.when(first <= last, F.sequence(first, F.greatest(first, last)))
    return table(spark, sf, "orders").select("o_orderkey", F.explode(years).alias("y"))


@query(
    "union_of_event_tables",
    with_(EVENTS)
    + "SELECT metric, COUNT(*) AS n_rows, CAST(SUM(count) AS BIGINT) AS total FROM events_long GROUP BY 1",
)
def _(spark, sf):
    long = events(spark, sf)
    frames = {m: long.where(F.col("metric") == m).drop("metric") for m in ("star", "fork", "issue", "pr")}
    return (
        tables.tagged_union(frames, "metric")
        .groupBy("metric")
        .agg(F.count("*").alias("n_rows"), F.sum("count").alias("total"))
    )


@query(
    "pivot_by_metric",
    f"""WITH {EVENTS} SELECT repo_id,
      {', '.join(f"CAST(SUM(count) FILTER (WHERE metric = '{m}') AS BIGINT) AS {m}" for m in ('star', 'fork', 'issue', 'pr'))}
    FROM events_long GROUP BY repo_id""",
)
def _(spark, sf):
    return (
        event_lines(spark, sf)
        .groupBy("repo_id")
        .pivot("metric", ["star", "fork", "issue", "pr"])
        .agg(F.sum("count"))
    )


_DIFF = """
  SELECT (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS n_left,
         (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'F') AS n_right,
         (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem
           WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')) AS only_left,
         (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'F'
           AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS only_right"""


def _key_sides(spark, sf):
    left = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    right = table(spark, sf, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("key"))
    return left, right


@query("key_set_difference", _DIFF)
def _(spark, sf):
    return quality.key_set_difference(*_key_sides(spark, sf), "key")


@query(
    "key_set_examples",
    """(SELECT 'left' AS side, l_orderkey AS key FROM lineitem WHERE l_orderkey NOT IN
        (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY 2 ORDER BY 2 LIMIT 3)
    UNION ALL
    (SELECT 'right', o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey NOT IN
        (SELECT l_orderkey FROM lineitem) ORDER BY 2 LIMIT 3)""",
)
def _(spark, sf):
    return quality.key_set_examples(*_key_sides(spark, sf), "key")


@query(
    "hash_set_difference",
    """SELECT (SELECT COUNT(DISTINCT md5(text)) FROM documents) AS n_left,
      (SELECT COUNT(DISTINCT md5(text)) FROM conversations) AS n_right,
      (SELECT COUNT(DISTINCT md5(text)) FROM documents WHERE text NOT IN (SELECT text FROM conversations)) AS only_left,
      (SELECT COUNT(DISTINCT md5(text)) FROM conversations WHERE text NOT IN (SELECT text FROM documents)) AS only_right""",
)
def _(spark, sf):
    return quality.hash_set_difference(
        table(spark, sf, "documents"), table(spark, sf, "conversations"), "text"
    )


@query(
    "field_differences",
    """SELECT o_orderkey, 'custkey' AS only_left, 'status' AS only_right, 'key,price' AS common
    FROM orders""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders")
    a = F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("price")))
    b = F.to_json(F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status")))
    wide = rows.select("o_orderkey", a.alias("a"), b.alias("b")).select(
        "o_orderkey", *quality.field_differences(F.col("a"), F.col("b"))
    )
    return wide.select(
        "o_orderkey", *(F.array_join(c, ",").alias(c) for c in ("only_left", "only_right", "common"))
    )


