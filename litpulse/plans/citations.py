"""Citation ranking: papers by cumulative citations, per window of publication dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litpulse.functions.dates import months_back, strict_iso_date, year_start
from litpulse.operators.intervals import top_in_spans
from litpulse.operators.merge import newest_per_key
from litpulse.operators.topk import hint_bounded, top_k

TOP_K = 500
# Window name to its length in months, both ends inclusive.
RECENT_MONTHS = {"recent_3m": 3, "recent_6m": 6, "recent_12m": 12}


def eligible_works(works: DataFrame) -> DataFrame:
    """Works with an id and citations; unknown flags pass, true ones do not."""
    return works.where(
        F.col("arxiv_id").isNotNull()
        & (F.trim("arxiv_id") != "")
        & (F.col("cited_by_count") > 0)
        & ~F.col("is_retracted").eqNullSafe(True)
        & ~F.col("is_paratext").eqNullSafe(True)
    )


def best_works(works: DataFrame) -> DataFrame:
    """The most cited work of each paper; the lower work id decides between equals."""
    return newest_per_key(
        eligible_works(works), ["arxiv_id"], [F.col("cited_by_count").desc(), F.col("work_id").asc()]
    )


def paper_citations(works: DataFrame) -> DataFrame:
    """Citations of each paper's best work. Ranking needs only the maximum, which
    combines ahead of the shuffle on two narrow columns."""
    return (
        eligible_works(works)
        .groupBy("arxiv_id")
        .agg(F.max("cited_by_count").cast("bigint").alias("cited_by_count"))
    )


def first_versions(papers: DataFrame) -> DataFrame:
    """One row per paper: earliest publication text, unknown dates last."""
    order = [F.col("published_date").asc_nulls_last()]
    if "title" in papers.columns:
        order.append(F.col("title").asc_nulls_last())
    return newest_per_key(papers, ["arxiv_id"], order)


def paper_dates(papers: DataFrame) -> DataFrame:
    """Publication date per paper, from its earliest publication text; null when that is no date."""
    dated = papers.where(F.col("published_date").isNotNull())
    earliest = dated.groupBy("arxiv_id").agg(F.min("published_date").alias("published_date"))
    return earliest.select("arxiv_id", strict_iso_date(F.col("published_date")).alias("paper_date"))


def citation_candidates(works: DataFrame, papers: DataFrame, as_of: dt.date) -> DataFrame:
    """Narrow candidates: id, citations, date; published no later than ``as_of``.

    Both sides arrive hashed by paper id from their aggregations, so the join
    shuffles nothing.
    """
    dates = paper_dates(papers).where(
        F.col("paper_date").isNotNull() & (F.col("paper_date") <= F.lit(as_of))
    )
    return paper_citations(works).join(dates, "arxiv_id")


def citation_windows(candidates: DataFrame, as_of: dt.date) -> DataFrame:
    """The window table: name, first and last publication date."""
    day = F.lit(as_of)
    meta = candidates.agg(F.min("paper_date").alias("first"))
    recent = [
        F.struct(F.lit(n).alias("window_name"), months_back(day, m).alias("start_date"), day.alias("end_date"))
        for n, m in RECENT_MONTHS.items()
    ]
    ytd = F.struct(F.lit("year_ytd").alias("window_name"), year_start(day).alias("start_date"), day.alias("end_date"))
    total = F.struct(F.lit("total").alias("window_name"), F.col("first").alias("start_date"), day.alias("end_date"))
    first_year, last_year = F.year("first"), F.lit(as_of.year - 1)
    years = F.transform(
        # A sequence would count down when there is no past year, so it is guarded.
        F.when(first_year <= last_year, F.sequence(first_year, F.greatest(first_year, last_year))),
        lambda y: F.struct(
            F.format_string("year_%d", y).alias("window_name"),
            F.make_date(y, F.lit(1), F.lit(1)).alias("start_date"),
            F.make_date(y, F.lit(12), F.lit(31)).alias("end_date"),
        ),
    )
    always = F.array(*recent, ytd)
    dated = F.when(F.col("first").isNotNull(), F.array(total))
    none = F.filter(always, lambda _: F.lit(False))
    return meta.select(
        F.inline(F.concat(always, F.coalesce(years, none), F.coalesce(dated, none)))
    )


def window_names(paper_date: Column, as_of: dt.date) -> Column:
    """Names of the windows a candidate belongs to, at most six.

    Replaces the range join of windows and candidates: a yearly window exists
    exactly when some candidate was published in it, and ``total`` starts at the
    earliest candidate, so a date alone decides.
    """
    day = F.lit(as_of)
    tests = [
        *(
            F.when(paper_date.between(months_back(day, m), day), F.lit(n))
            for n, m in RECENT_MONTHS.items()
        ),
        F.when(paper_date.between(year_start(day), day), F.lit("year_ytd")),
        F.when(F.year(paper_date) < as_of.year, F.concat(F.lit("year_"), F.year(paper_date))),
        F.lit("total"),
    ]
    return F.filter(F.array(*tests), lambda n: n.isNotNull())


def rank_candidates(candidates: DataFrame, as_of: dt.date, k: int = TOP_K) -> DataFrame:
    """Top k per window: more citations first, then the lower id."""
    members = candidates.select(
        F.explode(window_names(F.col("paper_date"), as_of)).alias("window_name"),
        "arxiv_id", "cited_by_count",
    )
    return top_k(
        members, ["window_name"], [F.col("cited_by_count").desc(), F.col("arxiv_id").asc()], k
    )


def rank_in_windows(candidates: DataFrame, windows: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top k per row of a window table (``window_name``, ``start_date``, ``end_date``).

    For windows that are not tied to the calendar and may be as many as there are candidates: both sides meet by
    equality on the nodes of a tree over days, of which each keeps its first ``k`` (``top_in_spans``); nothing is collected.
    """
    order = [F.col("cited_by_count").desc(), F.col("arxiv_id").asc()]
    members = top_in_spans(
        candidates.select("paper_date", "arxiv_id", "cited_by_count"), "paper_date", windows, "start_date", "end_date", order, k
    )
    return top_k(members.select("window_name", "arxiv_id", "cited_by_count"), ["window_name"], order, k)


def citation_rank_bound(as_of: dt.date, k: int = TOP_K, first_year: int = 1900) -> int:
    """The most rows one citation ranking can have."""
    return k * (len(RECENT_MONTHS) + 2 + max(as_of.year - first_year, 0))


def citation_ranking(works: DataFrame, papers: DataFrame, as_of: dt.date, k: int = TOP_K) -> DataFrame:
    """The ranking table of one version. Titles are fetched for the winners only."""
    ranked = rank_candidates(citation_candidates(works, papers, as_of), as_of, k)
    bound = citation_rank_bound(as_of, k)
    ids = hint_bounded(ranked.select("arxiv_id").distinct(), bound)
    titles = first_versions(
        papers.where(F.col("published_date").isNotNull())
        .select("arxiv_id", "published_date", "title")
        .join(ids, "arxiv_id", "left_semi")
    )
    return ranked.join(titles, "arxiv_id").select(
        F.lit(as_of).alias("as_of_date"), "window_name", "rank", "arxiv_id", "title", "cited_by_count"
    )


def citation_details(
    ranking: DataFrame, works: DataFrame, papers: DataFrame, as_of: dt.date, k: int = TOP_K
) -> DataFrame:
    """Wide rows of the ranked papers; both wide tables are cut to the winners first."""
    bound = citation_rank_bound(as_of, k)

    def winners(df: DataFrame) -> DataFrame:
        return df.join(
            hint_bounded(ranking.select("arxiv_id").distinct(), bound), "arxiv_id", "left_semi"
        )

    w = best_works(winners(works)).select(
        "arxiv_id", "work_id", F.col("cited_by_count").cast("bigint").alias("cited_by_count"),
        F.col("referenced_works_count").cast("int").alias("referenced_works_count"),
        F.col("publication_date").cast("date").alias("openalex_publication_date"),
        "publication_year", "type", "language", "is_oa", "oa_status", "authors_count",
        "primary_topic_name", "primary_topic_field", "primary_topic_domain",
    )
    p = first_versions(winners(papers)).select(
        "arxiv_id", "title", "abstract", "authors", "categories", "published_date", "doi", "datestamp"
    )
    return p.join(w, "arxiv_id").select(
        F.lit(as_of).alias("as_of_date"), "arxiv_id", "work_id", "title", "abstract", "authors",
        "categories", "published_date", "doi", "datestamp", "cited_by_count",
        "referenced_works_count", "openalex_publication_date", "publication_year", "type",
        "language", "is_oa", "oa_status", "authors_count", "primary_topic_name",
        "primary_topic_field", "primary_topic_domain",
    )
