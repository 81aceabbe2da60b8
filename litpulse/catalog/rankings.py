"""Registered queries: rankings, details and reader views."""

from __future__ import annotations

from pyspark.sql import functions as F

from litpulse.catalog.bindings import (
    EDGES, EVENTS, FIRST_YEAR, PAPERS, REPOS, SNAP, WORKS,
    edges, event_lines, events, papers, repos, table, with_, works,
)
from litpulse.catalog.registry import query
from litpulse.operators import quality
from litpulse.operators.topk import unpivot_windows
from litpulse.plans import activity, citations, reader
from litpulse.schemas import METRICS
from litpulse.session import materialise

BOUND = activity.rank_bound(SNAP, first_year=FIRST_YEAR)
AS_OF = SNAP

# Activity: SQL.
_WINDOWS = activity.activity_windows(SNAP, FIRST_YEAR)
WINDOW_NAMES = [w.name for w in _WINDOWS]


def _case(w) -> str:
    tests = [f"date >= DATE '{w.lower}'"] * bool(w.lower) + [f"date <= DATE '{w.upper}'"] * bool(w.upper)
    return f"CAST(SUM(CASE WHEN {' AND '.join(tests) or 'TRUE'} THEN count END) AS BIGINT) AS {w.name}"


REPO_ACTIVITY = (
    "ra AS (SELECT repo_id, metric, "
    + ", ".join(_case(w) for w in _WINDOWS)
    + " FROM events_long GROUP BY repo_id, metric)"
)
PAPER_ACTIVITY = (
    "pa AS (SELECT e.arxiv_id, r.metric, "
    + ", ".join(f"COALESCE(MAX(r.{n}), 0) AS {n}" for n in WINDOW_NAMES)
    + " FROM edges e JOIN ra r ON e.repo_id = r.repo_id GROUP BY e.arxiv_id, r.metric)"
)
D14 = f"""d14 AS (
  SELECT p.arxiv_id, r.metric, COALESCE(MAX(r.total), 0) AS value
  FROM papers p JOIN edges e ON e.arxiv_id = p.arxiv_id LEFT JOIN ra r ON r.repo_id = e.repo_id
  WHERE p.paper_date >= DATE '{SNAP}' - 13 GROUP BY p.arxiv_id, r.metric)"""
LONG = (
    "longform AS ("
    + " UNION ALL ".join(
        f"SELECT arxiv_id, metric, '{n}' AS window_name, {n} AS metric_value FROM pa WHERE {n} > 0"
        for n in WINDOW_NAMES
    )
    + " UNION ALL SELECT arxiv_id, metric, 'd14', value FROM d14 WHERE value > 0)"
)
RANKED = """ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY window_name, metric
                               ORDER BY metric_value DESC, arxiv_id) AS rank FROM longform)"""
RANKING = f"""ranking AS (
  SELECT DATE '{SNAP}' AS snapshot_date, window_name, metric, rank, r.arxiv_id, a.title, metric_value
  FROM ranked r JOIN papers a ON a.arxiv_id = r.arxiv_id WHERE rank <= 500)"""
BRIDGE = f"""bridge AS (
  SELECT DISTINCT DATE '{SNAP}' AS snapshot_date, arxiv_id, repo_id FROM edges
  WHERE arxiv_id IN (SELECT arxiv_id FROM ranking))"""
TOTALS = (
    "totals AS (SELECT repo_id, "
    + ", ".join(f"MAX(CASE WHEN metric = '{m}' THEN total END) AS {m}_total" for m in METRICS)
    + " FROM ra GROUP BY repo_id)"
)
LINKED = (
    "linked AS (SELECT b.snapshot_date, b.arxiv_id, b.repo_id, f.full_name, f.owner, "
    + ", ".join(f"COALESCE(t.{m}_total, 0) AS {m}_total" for m in METRICS)
    + " FROM bridge b LEFT JOIN totals t ON t.repo_id = b.repo_id"
    " LEFT JOIN repos f ON f.repo_id = b.repo_id)"
)
ACTIVITY = with_(EVENTS, EDGES, PAPERS, REPOS, REPO_ACTIVITY, PAPER_ACTIVITY, D14, LONG, RANKED, RANKING, BRIDGE, TOTALS, LINKED)

# Citations: SQL.
ELIGIBLE = """eligible AS (
  SELECT * FROM works WHERE arxiv_id IS NOT NULL AND trim(arxiv_id) <> '' AND cited_by_count > 0
    AND is_retracted IS NOT TRUE AND is_paratext IS NOT TRUE)"""
BEST = """best AS (
  SELECT * FROM eligible
  QUALIFY ROW_NUMBER() OVER (PARTITION BY arxiv_id ORDER BY cited_by_count DESC, work_id) = 1)"""
CANDIDATES = f"""candidates AS (
  SELECT w.arxiv_id, w.cited_by_count, p.paper_date, p.title
  FROM best w JOIN papers p ON p.arxiv_id = w.arxiv_id
  WHERE p.paper_date IS NOT NULL AND p.paper_date <= DATE '{AS_OF}')"""
CWINDOWS = f"""cwindows AS (
  SELECT 'recent_' || n || 'm' AS window_name,
         CAST(DATE '{AS_OF}' - to_months(CAST(n AS INTEGER)) + INTERVAL 1 DAY AS DATE) AS start_date,
         DATE '{AS_OF}' AS end_date
  FROM (VALUES (3), (6), (12)) v(n)
  UNION ALL SELECT 'year_ytd', make_date({AS_OF.year}, 1, 1), DATE '{AS_OF}'
  UNION ALL SELECT 'year_' || y, make_date(y, 1, 1), make_date(y, 12, 31)
    FROM (SELECT unnest(range(year(MIN(paper_date)), {AS_OF.year})) AS y FROM candidates) t
  UNION ALL SELECT 'total', MIN(paper_date), DATE '{AS_OF}' FROM candidates)"""
CRANKING = f"""cranking AS (
  SELECT DATE '{AS_OF}' AS as_of_date, window_name, rank, arxiv_id, title, cited_by_count FROM (
    SELECT w.window_name, c.*, ROW_NUMBER() OVER (PARTITION BY w.window_name
             ORDER BY c.cited_by_count DESC, c.arxiv_id) AS rank
    FROM cwindows w JOIN candidates c ON c.paper_date BETWEEN w.start_date AND w.end_date)
  WHERE rank <= 500)"""
CDETAILS = f"""cdetails AS (
  SELECT DATE '{AS_OF}' AS as_of_date, w.arxiv_id, w.work_id, p.title, p.abstract, p.authors,
         p.categories, p.published_date, p.doi, p.datestamp, w.cited_by_count,
         w.referenced_works_count, w.publication_date AS openalex_publication_date,
         w.publication_year, w.type, w.language, w.is_oa, w.oa_status, w.authors_count,
         w.primary_topic_name, w.primary_topic_field, w.primary_topic_domain
  FROM best w JOIN papers p ON p.arxiv_id = w.arxiv_id
  WHERE w.arxiv_id IN (SELECT arxiv_id FROM cranking))"""
CITATION = with_(WORKS, PAPERS, ELIGIBLE, BEST, CANDIDATES, CWINDOWS, CRANKING, CDETAILS)


# Activity: Spark.


def _repo_activity(spark, sf):
    return activity.repo_activity(event_lines(spark, sf), SNAP, FIRST_YEAR)


def _paper_activity(spark, sf):
    return activity.paper_activity(edges(spark, sf), _repo_activity(spark, sf))


def ranking(spark, sf):
    return activity.activity_ranking(
        event_lines(spark, sf), edges(spark, sf), papers(spark, sf), SNAP, first_year=FIRST_YEAR
    )


def stored_ranking(spark, sf):
    """The ranking as a written table; several steps read it."""
    return materialise(ranking(spark, sf), "ranking")


def _bridge(spark, sf, ranked):
    return activity.ranking_bridge(edges(spark, sf), ranked, SNAP, BOUND)


def _totals(spark, sf):
    return activity.repo_totals(_repo_activity(spark, sf))


def _linked(spark, sf, ranked):
    return activity.paper_linked_repos(_bridge(spark, sf, ranked), _totals(spark, sf), repos(spark, sf))


def stored_lists(spark, sf, ranked):
    """The ordered repository lists of a stored ranking, as a written table."""
    return materialise(activity.ordered_repos(_linked(spark, sf, ranked)), "linked")


def paper_detail_rows(spark, sf, size=activity.REPO_CHUNK):
    ranked = stored_ranking(spark, sf)
    return activity.paper_details(ranked, stored_lists(spark, sf, ranked), papers(spark, sf), SNAP, BOUND, size)


#: A repository of a list as JSON text, and the list of a paper in order.
REPO_JSON = "{'repo_id': repo_id, 'full_name': full_name, 'owner': owner, " + ", ".join(f"'{m}_total': {m}_total" for m in METRICS) + "}"
LISTED = """listed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY arxiv_id ORDER BY star_total DESC, repo_id) AS position FROM linked)"""


def json_list(list_column):
    return F.to_json(list_column, {"ignoreNullFields": "false"}).alias("linked_repos")


def repo_detail_rows(spark, sf):
    ranked = stored_ranking(spark, sf)
    return activity.repo_details(
        _bridge(spark, sf, ranked), _totals(spark, sf), repos(spark, sf), papers(spark, sf), SNAP, BOUND
    )


@query("repo_activity", with_(EVENTS, REPO_ACTIVITY) + "SELECT * FROM ra")
def _(spark, sf):
    return _repo_activity(spark, sf)


@query(
    "repo_activity_four_tables",
    with_(EVENTS, REPO_ACTIVITY) + "SELECT repo_id, metric, total, year_ytd FROM ra",
)
def _(spark, sf):
    long = events(spark, sf)
    tables = {m: long.where(F.col("metric") == m).drop("metric") for m in METRICS}
    return activity.repo_activity(activity.union_events(tables), SNAP, FIRST_YEAR).select(
        "repo_id", "metric", "total", "year_ytd"
    )


@query("paper_activity", with_(EVENTS, EDGES, REPO_ACTIVITY, PAPER_ACTIVITY) + "SELECT * FROM pa")
def _(spark, sf):
    return _paper_activity(spark, sf)


@query(
    "paper_activity_wide",
    with_(EVENTS, EDGES, REPO_ACTIVITY, PAPER_ACTIVITY)
    + "SELECT arxiv_id, "
    + ", ".join(
        f"COALESCE(MAX(CASE WHEN metric = '{m}' THEN {w} END), 0) AS {w}_{m}"
        for w in WINDOW_NAMES
        if not w.startswith("year_") or w == "year_ytd"
        for m in METRICS
    )
    + " FROM pa GROUP BY arxiv_id",
)
def _(spark, sf):
    return activity.paper_activity_wide(_paper_activity(spark, sf))


@query(
    "recent_paper_totals",
    with_(EVENTS, EDGES, PAPERS, REPO_ACTIVITY, D14)
    + "SELECT arxiv_id, "
    + ", ".join(f"COALESCE(MAX(CASE WHEN metric = '{m}' THEN value END), 0) AS {m}" for m in METRICS)
    + " FROM d14 GROUP BY arxiv_id",
)
def _(spark, sf):
    recent = activity.recent_papers(papers(spark, sf), SNAP)
    return activity.recent_totals(_repo_activity(spark, sf), edges(spark, sf), recent)


@query(
    "recent_papers",
    with_(PAPERS) + f"SELECT arxiv_id FROM papers WHERE paper_date >= DATE '{SNAP}' - 13",
)
def _(spark, sf):
    return activity.recent_papers(papers(spark, sf), SNAP)


@query(
    "unpivot_positive",
    with_(EVENTS, EDGES, REPO_ACTIVITY, PAPER_ACTIVITY, PAPERS, D14, LONG)
    + "SELECT window_name, metric, COUNT(*) AS n_rows, CAST(SUM(metric_value) AS BIGINT) AS total "
    "FROM longform WHERE window_name <> 'd14' GROUP BY 1, 2",
)
def _(spark, sf):
    long = unpivot_windows(
        _paper_activity(spark, sf), ["arxiv_id", "metric"], {n: n for n in WINDOW_NAMES}
    )
    return long.groupBy("window_name", "metric").agg(
        F.count("*").alias("n_rows"), F.sum("metric_value").alias("total")
    )


@query("activity_ranking", ACTIVITY + "SELECT * FROM ranking")
def _(spark, sf):
    return ranking(spark, sf)


@query(
    "activity_ranking_papers_first",
    with_(EVENTS, EDGES, PAPERS, REPO_ACTIVITY, PAPER_ACTIVITY, D14, LONG)
    + f"""SELECT DATE '{SNAP}' AS snapshot_date, window_name, metric, rank, r.arxiv_id, title, metric_value
    FROM (SELECT l.*, p.title, ROW_NUMBER() OVER (PARTITION BY window_name, metric
            ORDER BY metric_value DESC, l.arxiv_id) AS rank
          FROM longform l JOIN papers p ON p.arxiv_id = l.arxiv_id) r WHERE rank <= 20""",
)
def _(spark, sf):
    return activity.activity_ranking(
        event_lines(spark, sf), edges(spark, sf), papers(spark, sf), SNAP,
        k=20, first_year=FIRST_YEAR, require_paper_first=True,
    )


@query("ranking_bridge", ACTIVITY + "SELECT * FROM bridge")
def _(spark, sf):
    return _bridge(spark, sf, stored_ranking(spark, sf))


@query("repo_totals", with_(EVENTS, REPO_ACTIVITY, TOTALS) + "SELECT * FROM totals")
def _(spark, sf):
    return _totals(spark, sf)


@query("paper_linked_repos", ACTIVITY + "SELECT * FROM linked")
def _(spark, sf):
    return _linked(spark, sf, stored_ranking(spark, sf))


_SUMS = ", ".join(
    f"CAST({f}({m}_total) AS BIGINT) AS {m}_{f.lower()}" for m in METRICS for f in ("MAX", "SUM")
)


@query(
    "paper_details",
    ACTIVITY
    + f""", agg AS (SELECT arxiv_id, COUNT(*) AS repo_count, {_SUMS},
      CAST(to_json(list({REPO_JSON} ORDER BY star_total DESC, repo_id)) AS VARCHAR) AS linked_repos, 1 AS repo_chunks FROM linked GROUP BY arxiv_id)
    SELECT DATE '{SNAP}' AS snapshot_date, t.arxiv_id, a.title, a.abstract, a.authors, a.categories,
           a.published_date, a.datestamp, agg.* EXCLUDE (arxiv_id)
    FROM (SELECT DISTINCT arxiv_id FROM ranking) t LEFT JOIN papers a USING (arxiv_id)
    LEFT JOIN agg USING (arxiv_id)""",
)
def _(spark, sf):
    rows = paper_detail_rows(spark, sf).drop("openalex_data")
    return rows.withColumn("linked_repos", json_list(F.col("linked_repos")))


@query(
    "paper_repo_chunks",
    ACTIVITY
    + f""", {LISTED}
    SELECT arxiv_id, CAST((position - 1) // 2 AS BIGINT) AS chunk, CAST(to_json(list({REPO_JSON} ORDER BY position)) AS VARCHAR) AS linked_repos
    FROM listed GROUP BY ALL""",
)
def _(spark, sf):
    chunks = activity.paper_repo_chunks(stored_lists(spark, sf, stored_ranking(spark, sf)), size=2)
    return chunks.select("arxiv_id", "chunk", json_list(F.col("linked_repos")))


@query(
    "paper_details_repo_list",
    ACTIVITY
    + """SELECT arxiv_id, ROW_NUMBER() OVER (PARTITION BY arxiv_id ORDER BY star_total DESC, repo_id) AS position,
           repo_id, full_name, owner, star_total, fork_total, issue_total, pr_total FROM linked""",
)
def _(spark, sf):
    linked = activity.ordered_repos(_linked(spark, sf, stored_ranking(spark, sf)))
    return linked.select("arxiv_id", "position", "repo_id", "full_name", "owner", *(f"{m}_total" for m in METRICS))


@query(
    "repo_details",
    ACTIVITY
    + f"""SELECT DATE '{SNAP}' AS snapshot_date, r.repo_id, f.full_name, f.owner,
      {', '.join(f'COALESCE(m.{m}_total, 0) AS {m}_total' for m in METRICS)}, r.n_papers
    FROM (SELECT repo_id, COUNT(*) AS n_papers FROM bridge GROUP BY repo_id) r
    LEFT JOIN totals m ON m.repo_id = r.repo_id LEFT JOIN repos f ON f.repo_id = r.repo_id""",
)
def _(spark, sf):
    rows = repo_detail_rows(spark, sf)
    return rows.withColumn("n_papers", F.size("linked_papers")).drop("linked_papers")


@query(
    "repo_details_paper_list",
    ACTIVITY
    + """SELECT b.repo_id, ROW_NUMBER() OVER (PARTITION BY b.repo_id
             ORDER BY a.title NULLS LAST, b.arxiv_id) AS position, b.arxiv_id, a.title
    FROM bridge b LEFT JOIN papers a ON a.arxiv_id = b.arxiv_id""",
)
def _(spark, sf):
    rows = repo_detail_rows(spark, sf).select("repo_id", F.posexplode("linked_papers").alias("p", "l"))
    return rows.select("repo_id", (F.col("p") + 1).alias("position"), "l.*")


@query(
    "snapshot_row_counts",
    ACTIVITY
    + """SELECT 'ranking' AS table_name, COUNT(*) AS n_rows FROM ranking
    UNION ALL SELECT 'bridge', COUNT(*) FROM bridge
    UNION ALL SELECT 'paper_details', COUNT(DISTINCT arxiv_id) FROM ranking
    UNION ALL SELECT 'repo_details', COUNT(DISTINCT repo_id) FROM bridge""",
)
def _(spark, sf):
    ranked = stored_ranking(spark, sf)
    pairs = materialise(_bridge(spark, sf, ranked), "bridge")
    quality.require_rows(ranking=ranked, bridge=pairs)
    return quality.row_counts(
        {
            "ranking": ranked,
            "bridge": pairs,
            "paper_details": activity.ranked_ids(ranked),
            "repo_details": pairs.select("repo_id").distinct(),
        }
    )


@query(
    "ranking_constraints",
    ACTIVITY
    + """, bad AS (
      SELECT snapshot_date, CASE WHEN rank % 10 = 3 THEN 'week' ELSE window_name END AS window_name, CASE WHEN rank % 10 = 4 THEN 'likes' ELSE metric END AS metric,
        CASE WHEN rank % 10 = 5 THEN rank + 500 ELSE rank END AS rank, CASE WHEN rank % 10 <> 6 THEN arxiv_id END AS arxiv_id FROM ranking
      UNION ALL SELECT snapshot_date, window_name, metric, rank, arxiv_id FROM ranking WHERE rank % 10 = 7)
    SELECT unnest(['window_name', 'metric', 'rank_range', 'not_null', 'primary_key']) AS rule, unnest([
      count(*) FILTER (window_name = 'week'), count(*) FILTER (metric = 'likes'), count(*) FILTER (rank > 500), count(*) FILTER (arxiv_id IS NULL),
      (SELECT count(*) FROM (SELECT 1 FROM bad GROUP BY snapshot_date, window_name, metric, rank HAVING count(*) > 1))]) AS violations FROM bad""",
)
def _(spark, sf):
    rows = stored_ranking(spark, sf)
    last, change = F.col("rank") % 10, lambda digit, value, c: F.when(last == digit, value).otherwise(F.col(c)).alias(c)
    bad = rows.select(
        "snapshot_date", change(3, F.lit("week"), "window_name"), change(4, F.lit("likes"), "metric"),
        change(5, F.col("rank") + 500, "rank"), change(6, F.lit(None), "arxiv_id"),
    )
    return quality.ranking_violations(bad.unionByName(rows.where(last == 7).select(bad.columns)))


# Reader views.


@query(
    "reader_ranking_wide",
    ACTIVITY
    + """, wide AS (SELECT arxiv_id, title,
        MAX(CASE WHEN metric = 'star' THEN metric_value END) AS star,
        MAX(CASE WHEN metric = 'fork' THEN metric_value END) AS fork,
        MAX(CASE WHEN metric = 'issue' THEN metric_value END) AS issue,
        MAX(CASE WHEN metric = 'pr' THEN metric_value END) AS pr
      FROM ranking WHERE window_name = 'rolling_3m' AND title IS NOT NULL GROUP BY 1, 2)
    SELECT ROW_NUMBER() OVER (ORDER BY star DESC NULLS LAST, arxiv_id) AS rank, * FROM wide""",
)
def _(spark, sf):
    return reader.ranking_wide(stored_ranking(spark, sf), "rolling_3m")


@query(
    "reader_window_options",
    ACTIVITY
    + """, names AS (SELECT DISTINCT window_name AS w FROM ranking)
    SELECT ROW_NUMBER() OVER (ORDER BY
        CASE WHEN w = 'd14' THEN 0 WHEN w LIKE 'rolling%' THEN 1 WHEN w = 'year_ytd' THEN 2
             WHEN w LIKE 'year%' THEN 3 ELSE 99 END,
        CASE WHEN w LIKE 'year_%' AND w <> 'year_ytd' THEN substr(w, 6) END DESC NULLS LAST,
        CASE w WHEN 'rolling_7d' THEN 1 WHEN 'rolling_30d' THEN 2 WHEN 'rolling_3m' THEN 3 ELSE 4 END
      ) AS position, w AS window_name,
      CASE w WHEN 'd14' THEN '论文发表后14天'
             WHEN 'rolling_7d' THEN '最近7天（各维度均以 GitHub 事件更新时间作为时间基准，并据此关联论文。）'
             WHEN 'rolling_30d' THEN '最近30天' WHEN 'rolling_3m' THEN '最近3个月'
             WHEN 'rolling_6m' THEN '最近6个月' WHEN 'total' THEN '总榜'
             WHEN 'year_ytd' THEN '2001年YTD' ELSE substr(w, 6) || '年' END AS label
    FROM names""",
)
def _(spark, sf):
    return reader.window_options(ranking(spark, sf), SNAP)


@query(
    "reader_paper_card",
    ACTIVITY
    + """SELECT arxiv_id, position, label, value FROM (
      SELECT p.arxiv_id, unnest([0, 1, 2, 3, 4]) AS position,
             unnest(['title', '发布时间', '作者', '分类', '摘要']) AS label,
             unnest([p.title, p.published_date, p.authors, p.categories, p.abstract]) AS value
      FROM papers p WHERE p.arxiv_id IN (SELECT arxiv_id FROM ranking))""",
)
def _(spark, sf):
    return reader.card_rows(paper_detail_rows(spark, sf), reader.ACTIVITY_CARD)


@query(
    "reader_card_repos",
    ACTIVITY
    + """, o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY arxiv_id ORDER BY star_total DESC, repo_id) AS rn
                 FROM linked)
    SELECT arxiv_id, COUNT(*) AS n_repos, GREATEST(COUNT(*) - 20, 0) AS n_more,
           string_agg(full_name, '|' ORDER BY rn) FILTER (WHERE rn <= 20) AS shown
    FROM o GROUP BY arxiv_id""",
)
def _(spark, sf):
    return reader.card_repos(paper_detail_rows(spark, sf)).withColumn(
        "shown", F.array_join("shown", "|")
    )


@query(
    "reader_card_repos_from_json",
    ACTIVITY + "SELECT arxiv_id, COUNT(*) AS n_repos FROM linked GROUP BY arxiv_id",
)
def _(spark, sf):
    chunks = activity.paper_repo_chunks(stored_lists(spark, sf, stored_ranking(spark, sf)), size=2)
    as_text = chunks.select("arxiv_id", "chunk", json_list(F.col("linked_repos")))
    return reader.card_repos_of_chunks(as_text).select("arxiv_id", "n_repos")


@query(
    "reader_find_paper",
    ACTIVITY
    + """SELECT arxiv_id, title, authors FROM papers
    WHERE arxiv_id = (SELECT MIN(arxiv_id) FROM ranking)""",
)
def _(spark, sf):
    rows = materialise(paper_detail_rows(spark, sf).select("arxiv_id", "title", "authors"), "details")
    lowest = rows.agg(F.min("arxiv_id")).first()[0]
    return reader.find_paper(rows, lowest)


# Citations: Spark.


def _candidates(spark, sf):
    return citations.citation_candidates(works(spark, sf), papers(spark, sf), AS_OF)


def cranking(spark, sf):
    return citations.citation_ranking(works(spark, sf), papers(spark, sf), AS_OF)


def cdetails(spark, sf, ranked):
    return citations.citation_details(ranked, works(spark, sf), papers(spark, sf), AS_OF)


@query("eligible_works", with_(WORKS, ELIGIBLE) + "SELECT work_id, arxiv_id, cited_by_count FROM eligible")
def _(spark, sf):
    return citations.eligible_works(works(spark, sf)).select("work_id", "arxiv_id", "cited_by_count")


@query("best_works", with_(WORKS, ELIGIBLE, BEST) + "SELECT arxiv_id, work_id, cited_by_count FROM best")
def _(spark, sf):
    return citations.best_works(works(spark, sf)).select("arxiv_id", "work_id", "cited_by_count")


@query(
    "first_versions",
    with_(EDGES)
    + """SELECT arxiv_id, CAST(MIN(date) AS VARCHAR) AS published_date FROM edges GROUP BY arxiv_id""",
)
def _(spark, sf):
    # Each edge date stands for one stored version of its paper.
    versions = edges(spark, sf).select(
        "arxiv_id", F.date_format("date", "yyyy-MM-dd").alias("published_date")
    )
    return citations.first_versions(versions)


@query(
    "citation_candidates",
    with_(WORKS, PAPERS, ELIGIBLE, BEST, CANDIDATES)
    + "SELECT arxiv_id, cited_by_count, paper_date FROM candidates",
)
def _(spark, sf):
    return _candidates(spark, sf)


@query(
    "citation_windows",
    with_(WORKS, PAPERS, ELIGIBLE, BEST, CANDIDATES, CWINDOWS) + "SELECT * FROM cwindows",
)
def _(spark, sf):
    return citations.citation_windows(_candidates(spark, sf), AS_OF)


@query("citation_ranking", CITATION + "SELECT * FROM cranking")
def _(spark, sf):
    return cranking(spark, sf)


@query(
    "citation_ranking_by_window_table",
    CITATION + "SELECT window_name, rank, arxiv_id, cited_by_count FROM cranking",
)
def _(spark, sf):
    found = _candidates(spark, sf)
    return citations.rank_in_windows(found, citations.citation_windows(found, AS_OF))


@query(
    "citation_ranking_many_windows",
    CITATION
    + """, windows AS (SELECT 'w' || p_partkey AS window_name, DATE '1995-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS start_date,
        DATE '1995-01-01' + CAST(p_partkey % 1500 + p_partkey * 7 % 400 - 5 AS INTEGER) AS end_date FROM part)
    SELECT window_name, rank, arxiv_id, cited_by_count FROM (
      SELECT window_name, arxiv_id, cited_by_count,
        ROW_NUMBER() OVER (PARTITION BY window_name ORDER BY cited_by_count DESC, arxiv_id) AS rank
      FROM candidates JOIN windows ON paper_date BETWEEN start_date AND end_date) WHERE rank <= 3""",
)
def _(spark, sf):
    key, first = F.col("p_partkey"), F.lit("1995-01-01").cast("date")
    windows = table(spark, sf, "part").select(
        F.concat(F.lit("w"), key.cast("string")).alias("window_name"),
        F.date_add(first, (key % 1500).cast("int")).alias("start_date"),
        F.date_add(first, (key % 1500 + key * 7 % 400 - 5).cast("int")).alias("end_date"),
    )
    return citations.rank_in_windows(_candidates(spark, sf), windows, k=3)


@query("citation_details", CITATION + "SELECT * FROM cdetails")
def _(spark, sf):
    return cdetails(spark, sf, materialise(cranking(spark, sf), "citations"))


@query(
    "citation_list",
    CITATION
    + "SELECT rank, arxiv_id, title, cited_by_count FROM cranking WHERE window_name = 'recent_3m'",
)
def _(spark, sf):
    return reader.citation_list(cranking(spark, sf), "recent_3m")


@query(
    "citation_card",
    CITATION
    + """, card AS (SELECT arxiv_id, unnest(range(0, 13)) AS position,
        unnest(['title', '累计引用', 'arXiv 发布时间', 'OpenAlex 发布日期', '作者', '分类', '类型', 'OA 状态',
                '主要主题', '主题领域', '主题域', 'DOI', '摘要']) AS label,
        unnest([title, CAST(cited_by_count AS VARCHAR), published_date,
                CAST(openalex_publication_date AS VARCHAR), authors, categories, type, oa_status,
                primary_topic_name, primary_topic_field, primary_topic_domain, doi, abstract]) AS value
      FROM cdetails)
    SELECT * FROM card""",
)
def _(spark, sf):
    rows = cdetails(spark, sf, materialise(cranking(spark, sf), "citations"))
    return reader.card_rows(rows, reader.CITATION_CARD)


@query(
    "citation_report",
    CITATION
    + """SELECT (SELECT COUNT(*) FROM cranking) AS n_ranking,
      (SELECT COUNT(DISTINCT window_name) FROM cranking) AS n_windows,
      (SELECT MAX(rank) FROM cranking) AS max_rank,
      (SELECT COUNT(*) FROM cdetails) AS n_details, CAST(0 AS BIGINT) AS n_bad_windows,
      CAST(0 AS BIGINT) AS n_missing_details, 'completed' AS status, TRUE AS passed""",
)
def _(spark, sf):
    ranked = materialise(cranking(spark, sf), "citations")
    details = materialise(cdetails(spark, sf, ranked), "citation-details")
    quality.require_rows(ranking=ranked, details=details)
    quality.require_contiguous(ranked)
    return quality.citation_report(ranked, details, F.lit("completed"))


@query(
    "citation_constraints",
    CITATION
    + """, bad AS (
      SELECT as_of_date, window_name, CASE WHEN rank % 10 = 5 THEN rank + 500 ELSE rank END AS rank, CASE WHEN rank % 10 <> 6 THEN cited_by_count END AS cited FROM cranking
      UNION ALL SELECT as_of_date, CASE WHEN rank % 20 = 7 THEN window_name END, rank, cited_by_count FROM cranking WHERE rank % 10 = 7)
    SELECT unnest(['rank_range', 'cited_not_null', 'primary_key']) AS rule, unnest([
      count(*) FILTER (rank > 500), count(*) FILTER (cited IS NULL),
      (SELECT count(*) FROM (SELECT 1 FROM bad GROUP BY as_of_date, window_name, rank HAVING count(*) > 1 OR window_name IS NULL))]) AS violations FROM bad""",
)
def _(spark, sf):
    rows = materialise(cranking(spark, sf), "citations").select("as_of_date", "window_name", "rank", "cited_by_count")
    last = F.col("rank") % 10
    bad = rows.withColumns({"rank": F.when(last == 5, F.col("rank") + 500).otherwise(F.col("rank")), "cited_by_count": F.when(last != 6, F.col("cited_by_count"))})
    again = rows.where(last == 7).withColumn("window_name", F.when(F.col("rank") % 20 == 7, F.col("window_name")))
    return quality.citation_violations(bad.unionByName(again))


@query(
    "missing_details",
    CITATION
    + """SELECT DISTINCT as_of_date, arxiv_id FROM cranking
    WHERE arxiv_id NOT IN (SELECT arxiv_id FROM cdetails WHERE type = 'A')""",
)
def _(spark, sf):
    ranked = materialise(cranking(spark, sf), "citations")
    return quality.missing_details(ranked, cdetails(spark, sf, ranked).where("type = 'A'"))


@query(
    "bad_rank_windows",
    ACTIVITY
    + """SELECT window_name, COUNT(*) AS n_rows, MAX(rank) AS max_rank FROM ranking
    WHERE metric = 'star' AND rank % 7 <> 0 GROUP BY window_name
    HAVING COUNT(*) > 500 OR COUNT(*) <> MAX(rank)""",
)
def _(spark, sf):
    # Every seventh rank is taken out to make the gaps that the check reports.
    gaps = ranking(spark, sf).where("metric = 'star' AND rank % 7 <> 0")
    return quality.bad_rank_windows(gaps)
