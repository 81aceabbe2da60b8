"""Reader views over the published tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litpulse.functions.jsons import linked_repo_array
from litpulse.functions.text import is_missing
from litpulse.operators.ranks import numbered
from litpulse.operators.topk import pivot_metrics
from litpulse.schemas import METRICS

CARD_REPOS = 20

# Display texts of the windows.
WINDOW_LABELS = {
    "d14": "论文发表后14天",
    "rolling_7d": "最近7天（各维度均以 GitHub 事件更新时间作为时间基准，并据此关联论文。）",
    "rolling_30d": "最近30天",
    "rolling_3m": "最近3个月",
    "rolling_6m": "最近6个月",
    "recent_3m": "近3个月",
    "recent_6m": "近6个月",
    "recent_12m": "近12个月",
    "total": "总榜",
}
ROLLING_LABEL, YEAR_LABEL, YTD_LABEL = "最近", "年", "年YTD"
UNTITLED = "无标题"
# Windows shown ahead of the years, in order, and the one shown last.
FIRST_WINDOWS = (
    "d14",
    "rolling_7d",
    "rolling_30d",
    "recent_3m",
    "rolling_3m",
    "recent_6m",
    "rolling_6m",
    "recent_12m",
    "year_ytd",
)
LAST_WINDOW = "total"
# Fields of a detail card, in order, with their labels.
ACTIVITY_CARD = (
    ("published_date", "发布时间"),
    ("authors", "作者"),
    ("categories", "分类"),
    ("abstract", "摘要"),
)
CITATION_CARD = (
    ("cited_by_count", "累计引用"),
    ("published_date", "arXiv 发布时间"),
    ("openalex_publication_date", "OpenAlex 发布日期"),
    ("authors", "作者"),
    ("categories", "分类"),
    ("type", "类型"),
    ("oa_status", "OA 状态"),
    ("primary_topic_name", "主要主题"),
    ("primary_topic_field", "主题领域"),
    ("primary_topic_domain", "主题域"),
    ("doi", "DOI"),
    ("abstract", "摘要"),
)


def window_label(name: Column, snap_year: Column) -> Column:
    """Display text of a window name."""
    label = F.create_map(*(F.lit(x) for pair in WINDOW_LABELS.items() for x in pair))
    return (
        F.when(F.map_contains_key(label, name), F.try_element_at(label, name))
        .when(name == "year_ytd", F.concat(snap_year.cast("string"), F.lit(YTD_LABEL)))
        .when(
            F.startswith(name, F.lit("rolling_")),
            F.concat(F.lit(ROLLING_LABEL), F.replace(name, F.lit("rolling_"), F.lit(""))),
        )
        .when(F.startswith(name, F.lit("year_")), F.concat(F.substr(name, F.lit(6)), F.lit(YEAR_LABEL)))
        .otherwise(name)
    )


def window_order(name: Column) -> list[Column]:
    """Sort columns: the first windows, years downwards, others by name, the last one."""
    place = F.array_position(F.array(*map(F.lit, FIRST_WINDOWS)), name)
    listed = place > 0
    year = F.startswith(name, F.lit("year_")) & ~listed
    return [
        (name == LAST_WINDOW).asc(),
        listed.desc(),
        place.asc(),
        year.desc(),
        F.when(year, F.substr(name, F.lit(6))).desc_nulls_last(),
        name.asc(),
    ]


def window_options(ranking: DataFrame, snap: dt.date) -> DataFrame:
    """The windows present in a ranking, in display order with their labels."""
    names = ranking.select("window_name").distinct()
    position = F.row_number().over(Window.orderBy(*window_order(F.col("window_name"))))
    return names.select(  # tens of rows
        position.alias("position"),
        "window_name",
        window_label(F.col("window_name"), F.lit(snap.year)).alias("label"),
    )


def ranking_wide(ranking: DataFrame, window: str) -> DataFrame:
    """One window of a stored ranking as a table with a column per metric, ranked again.

    The primary metric is the first of star, fork, issue, pr with any value; it is found first, from one row of counts.
    A paper without a title has no row. Numbering takes as many tasks as the rows fill.
    """
    rows = ranking.where((F.col("window_name") == window) & F.col("title").isNotNull())
    values = rows.agg(*(F.count(F.when(F.col("metric") == m, F.col("metric_value"))).alias(m) for m in METRICS)).first()
    primary = next((m for m in METRICS if values[m]), METRICS[0])
    wide = pivot_metrics(rows, ["arxiv_id", "title"], "metric_value", METRICS)
    ranked = numbered(wide, [], [F.col(primary).desc_nulls_last(), F.col("arxiv_id").asc()], "rank")
    return ranked.select("rank", "arxiv_id", "title", *METRICS)


def citation_list(ranking: DataFrame, window: str) -> DataFrame:
    """One window of the citation ranking in rank order."""
    return (
        ranking.where(F.col("window_name") == window)
        .select("rank", "arxiv_id", "title", "cited_by_count")
        .orderBy("rank", "arxiv_id")
    )


def find_paper(details: DataFrame, arxiv_id: str) -> DataFrame:
    """The detail row of one paper; no row when it is unknown."""
    return details.where(F.col("arxiv_id") == arxiv_id).limit(1)


def card_rows(details: DataFrame, card: tuple[tuple[str, str], ...]) -> DataFrame:
    """Detail cards as rows: paper, position, label, value; missing values are left out."""
    kinds = dict(details.dtypes)
    title = F.when(is_missing(F.col("title"), "string"), F.lit(UNTITLED)).otherwise(F.col("title"))
    entries = [F.struct(F.lit(0).alias("position"), F.lit("title").alias("label"), title.alias("value"))]
    for i, (c, label) in enumerate(card, start=1):
        value = F.when(~is_missing(F.col(c), kinds[c]), F.col(c).cast("string"))
        entries.append(F.struct(F.lit(i).alias("position"), F.lit(label).alias("label"), value.alias("value")))
    present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return details.select("arxiv_id", F.inline(present))


def card_repos(details: DataFrame, shown: int = CARD_REPOS) -> DataFrame:
    """Repositories on a card: the first ``shown`` names, the total and how many are left."""
    listed = F.col("linked_repos")
    if dict(details.dtypes)["linked_repos"] == "string":
        listed = linked_repo_array(listed)
    n = F.greatest(F.col("repo_count"), F.size(listed)) if "repo_count" in details.columns else F.size(listed)
    names = F.transform(F.slice(listed, 1, shown), lambda r: F.coalesce(r["full_name"], F.lit("")))
    return details.select(
        "arxiv_id",
        n.cast("bigint").alias("n_repos"),
        names.alias("shown"),
        F.greatest(n - shown, F.lit(0)).cast("bigint").alias("n_more"),
    )


def card_repos_of_chunks(chunks: DataFrame, shown: int = CARD_REPOS) -> DataFrame:
    """The same from the numbered chunks of a list, as arrays or JSON text: all chunks count, the first is shown.

    ``shown`` is at most the size of a chunk.
    """
    listed = F.col("linked_repos")
    if dict(chunks.dtypes)["linked_repos"] == "string":
        listed = linked_repo_array(listed)
    names = F.transform(F.slice(listed, 1, shown), lambda r: F.coalesce(r["full_name"], F.lit("")))
    each = chunks.select("arxiv_id", F.size(listed).alias("n"), F.when(F.col("chunk") == 0, names).alias("names"))
    n = F.sum("n")
    return each.groupBy("arxiv_id").agg(
        n.alias("n_repos"), F.max("names").alias("shown"), F.greatest(n - shown, F.lit(0)).alias("n_more")
    )
