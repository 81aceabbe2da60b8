"""Activity ranking: papers by the activity of the repositories that cite them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litpulse.functions.dates import ISO_DATE_PREFIX, iso_date
from litpulse.operators.ranks import numbered
from litpulse.operators.topk import (
    hint_bounded,
    pivot_metrics,
    top_k_few_groups,
    unpivot_windows,
    value_floor,
)
from litpulse.schemas import LINKED_REPO, METRICS
from litpulse.session import materialise
from litpulse.sources.tables import tagged_union

TOP_K = 500
FIRST_YEAR = 2008
RECENT_DAYS = 14
# Days each rolling window reaches back, the snapshot day included.
ROLLING_DAYS = {"rolling_7d": 7, "rolling_30d": 30, "rolling_3m": 90, "rolling_6m": 180}
# Hash slots papers are counted by, and edges of a slot from which on its papers' rows combine ahead of the shuffle.
HOT_SLOTS, HOT_LINKS = 65_536, 100_000
# The floors of the ranking come from so many times k highest repositories of a window and metric, for recent papers from more.
FLOOR_REPOS, FLOOR_REPOS_RECENT = 4, 32
# Repositories of a chunk of a paper's list.
REPO_CHUNK = 1000


@dataclass(frozen=True)
class ActivityWindow:
    """A window of the ranking and the rows it counts: ``lower <= date <= upper``."""

    name: str
    lower: dt.date | None
    upper: dt.date | None


def activity_windows(snap: dt.date, first_year: int = FIRST_YEAR) -> list[ActivityWindow]:
    """Windows fed by events. Rolling windows and the year to date have no upper bound;
    a yearly window is cumulative to the end of its year; there are no yearly windows
    when the snapshot year is not after the first year.
    """
    rolling = [
        ActivityWindow(name, snap - dt.timedelta(days=days - 1), None)
        for name, days in ROLLING_DAYS.items()
    ]
    years = [
        ActivityWindow(f"year_{y}", None, dt.date(y, 12, 31)) for y in range(first_year, snap.year)
    ]
    return [
        *rolling,
        ActivityWindow("year_ytd", dt.date(snap.year, 1, 1), None),
        ActivityWindow("total", None, None),
        *years,
    ]


def union_events(tables: dict[str, DataFrame]) -> DataFrame:
    """The per-metric event tables as one long table with column ``metric``."""
    return tagged_union({m: tables[m].select("repo_id", "date", "count") for m in METRICS}, "metric")


def _spans(windows: list[ActivityWindow]) -> list[Column]:
    """Tests on ``date`` of the spans between the bounds of the windows, in order; the last is for rows without a date."""
    bounds = sorted({w.lower for w in windows if w.lower} | {w.upper + dt.timedelta(days=1) for w in windows if w.upper})
    date = F.col("date")
    inside = [(date >= F.lit(a) if a else F.lit(True)) & (date < F.lit(b) if b else F.lit(True)) for a, b in zip([None, *bounds], [*bounds, None], strict=True)]
    return [*(x & date.isNotNull() for x in inside), date.isNull()]


def _windowed(window: ActivityWindow, windows: list[ActivityWindow]) -> Column:
    """The sum of a window from the sums of the spans it holds; null if none of them has a row."""
    bounds = sorted({w.lower for w in windows if w.lower} | {w.upper + dt.timedelta(days=1) for w in windows if w.upper})
    first = bounds.index(window.lower) + 1 if window.lower else 0
    last = bounds.index(window.upper + dt.timedelta(days=1)) + 1 if window.upper else len(bounds) + 1
    held = [F.col(f"__span{i}") for i in range(first, last)] + [F.col(f"__span{len(bounds) + 1}")] * (window.name == "total")
    return F.when(F.coalesce(*held).isNotNull(), sum((F.coalesce(x, F.lit(0)) for x in held[1:]), F.coalesce(held[0], F.lit(0)))).alias(window.name)


def repo_activity(events: DataFrame, snap: dt.date, first_year: int = FIRST_YEAR) -> DataFrame:
    """One row per repository and metric with a sum per window, in one pass.

    Sums combine ahead of the shuffle, so a repository with a third of all events
    sends one row per task and metric. A row has a sum per span between the windows' bounds, most of
    them null, and the windows add these up. Kept long by metric: the row stays under
    the column count at which whole-stage code generation is given up.
    """
    windows = activity_windows(snap, first_year)
    sums = (F.sum(F.when(test, F.col("count"))).alias(f"__span{i}") for i, test in enumerate(_spans(windows)))
    return events.groupBy("repo_id", "metric").agg(*sums).select("repo_id", "metric", *(_windowed(w, windows) for w in windows))


def _values(activity: DataFrame) -> list[str]:
    return [c for c in activity.columns if c not in ("repo_id", "metric")]


def linked_activity(edges: DataFrame, activity: DataFrame) -> DataFrame:
    """One row per paper and metric: the maximum over the linked repositories.

    A maximum does not care about repeated edges, so edges need no distinct. It
    combines ahead of the shuffle, which absorbs a paper linked by very many
    repositories; a repository that links very many papers is split by the
    adaptive skew join.
    """
    return (
        edges.select("arxiv_id", "repo_id")
        .join(activity, "repo_id")
        .groupBy("arxiv_id", "metric")
        .agg(*(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in _values(activity)))
    )


def packed_activity(activity: DataFrame) -> DataFrame:
    """The ``metrics`` of a repository in one row, with the values of all of them, one metric after the other.

    Metrics whose values are all numbers of two bytes have them in ``small``; a second row has the others' in ``large``.
    """
    rows = activity.select("repo_id", "metric", F.array(*(F.col(f"`{c}`") for c in _values(activity))).alias("v"))
    fits = F.forall("v", lambda x: x.try_cast("smallint").eqNullSafe(x))
    listed = rows.groupBy("repo_id", fits.alias("fits")).agg(F.collect_list(F.struct("metric", "v")).alias("rows"))
    values = F.flatten("rows.v")
    small = F.when(F.col("fits"), F.transform(values, lambda x: x.try_cast("smallint")))
    return listed.select("repo_id", F.col("rows.metric").alias("metrics"), small.alias("small"), F.when(~F.col("fits"), values).alias("large"))


def paper_activity(edges: DataFrame, activity: DataFrame, hot_links: int = HOT_LINKS) -> DataFrame:
    """``linked_activity`` of every paper there is, with one packed row per edge on the way to its paper.

    A paper of very many edges would meet in one task. Papers are counted by ``HOT_SLOTS`` hash slots; where a slot has
    ``hot_links`` edges or more, its papers' rows combine ahead of the shuffle instead. The slots are broadcast.
    """
    names = _values(activity)
    pairs = edges.select("arxiv_id", "repo_id", F.pmod(F.xxhash64("arxiv_id"), F.lit(HOT_SLOTS)).alias("slot"))
    hot = F.broadcast(pairs.groupBy("slot").agg(F.count("*").alias("n")).where(F.col("n") >= hot_links).select("slot"))
    packed = pairs.join(hot, "slot", "left_anti").join(packed_activity(activity), "repo_id")
    packed = packed.select("arxiv_id", "metrics", "small", "large").repartition("arxiv_id")
    rows = packed.select("arxiv_id", "small", "large", F.posexplode("metrics").alias("at", "metric"))

    def value(i: int) -> Column:
        place = F.col("at") * len(names) + i
        kind = activity.schema[names[i]].dataType
        return F.coalesce(F.col("small")[place].cast(kind), F.col("large")[place].cast(kind))

    highest = (F.coalesce(F.max(value(i)), F.lit(0)).alias(c) for i, c in enumerate(names))
    cold = rows.groupBy("arxiv_id", "metric").agg(*highest)
    return cold.union(linked_activity(pairs.join(hot, "slot", "left_semi"), activity))


def paper_activity_wide(by_paper: DataFrame) -> DataFrame:
    """One row per paper: a column ``window_metric`` for every window but the yearly ones; absent is zero."""
    windows = [*ROLLING_DAYS, "year_ytd", "total"]
    return by_paper.groupBy("arxiv_id").agg(
        *(
            F.coalesce(F.max(F.when(F.col("metric") == m, F.col(w))), F.lit(0)).alias(f"{w}_{m}")
            for w in windows
            for m in METRICS
        )
    )


def recent_totals(activity: DataFrame, edges: DataFrame, recent: DataFrame) -> DataFrame:
    """One row per recent paper that has a repository, with its total per metric, the maximum over its repositories.

    A paper whose repositories show no activity has a row of zeros. Edges are cut to the recent papers
    before anything else, so only their repositories' totals meet them.
    """
    linked = edges.select("arxiv_id", "repo_id").join(recent.select("arxiv_id"), "arxiv_id", "left_semi")
    totals = linked.join(repo_totals(activity), "repo_id", "left")
    return totals.groupBy("arxiv_id").agg(*(F.coalesce(F.max(f"{m}_total"), F.lit(0)).alias(m) for m in METRICS))


def recent_papers(papers: DataFrame, snap: dt.date, days: int = RECENT_DAYS) -> DataFrame:
    """Ids of papers published in the last ``days`` days, the snapshot day included.

    There is no upper bound. The text comparison lets the Parquet reader skip row
    groups; the format test and the parsed date decide.
    """
    first = snap - dt.timedelta(days=days - 1)
    text = F.col("published_date")
    return papers.where(
        text.isNotNull()
        & (text >= first.isoformat())
        & text.rlike(ISO_DATE_PREFIX)
        & (iso_date(text) >= F.lit(first))
    ).select("arxiv_id")


def ranked_papers(by_paper: DataFrame, recent: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top k per window and metric: higher value first, then the lower id.

    ``d14`` ranks recent papers by the total of their repositories. That total is
    already in ``by_paper``, so the window costs one join with the recent ids
    rather than a second pass over edges and activity.
    """
    names = [c for c in by_paper.columns if c not in ("arxiv_id", "metric")]
    flagged = by_paper.join(
        recent.distinct().withColumn("__recent", F.lit(True)), "arxiv_id", "left"
    ).withColumn("d14", F.when(F.col("__recent"), F.col("total")))
    long = unpivot_windows(flagged, ["arxiv_id", "metric"], {n: n for n in [*names, "d14"]})
    return top_k_few_groups(
        long, ["window_name", "metric"], "metric_value", [F.col("arxiv_id").asc()], k
    )


def rank_floors(activity: DataFrame, edges: DataFrame, recent: DataFrame, k: int = TOP_K) -> list[tuple[str, str, int]]:
    """Per window and metric a value that every paper among the k highest reaches: ``(window_name, metric, value)``.

    A paper counts for the lowest of its repositories, so the papers of several repositories add up. From the highest
    value down, repositories are passed until they count for k papers; each of those has that value at least, so nothing lower
    can rank. Only the highest repositories of a window and metric are passed, and only their edges; where these do not
    count for k papers there is no floor. One row per window and metric comes to the driver.
    """
    names, groups = _values(activity), ["window_name", "metric"]
    long = unpivot_windows(activity.withColumn("d14", F.col("total")), ["repo_id", "metric"], {n: n for n in [*names, "d14"]})
    passed = F.when(F.col("window_name") == "d14", FLOOR_REPOS_RECENT * k).otherwise(FLOOR_REPOS * k)
    lowest = F.broadcast(value_floor(long, groups, "metric_value", passed).drop("__reached"))  # one row per group
    high = materialise(long.join(lowest, groups).where(F.col("metric_value") >= F.col("__floor")).drop("__floor"), "high_activity")
    linked = edges.select("arxiv_id", "repo_id").join(high.select("repo_id").distinct(), "repo_id", "left_semi")
    owner = linked.groupBy("arxiv_id").agg(F.min("repo_id").alias("repo_id"))
    owner = owner.join(recent.distinct().withColumn("__recent", F.lit(True)), "arxiv_id", "left")
    owned = owner.groupBy("repo_id").agg(F.count("*").alias("__papers"), F.count("__recent").alias("__fresh"))
    papers = F.when(F.col("window_name") == "d14", F.col("__fresh")).otherwise(F.col("__papers"))
    weighed = high.join(owned, "repo_id", "left")
    floors = value_floor(weighed, groups, "metric_value", k, F.coalesce(papers, F.lit(0))).where(F.col("__reached") >= k)
    return [tuple(r) for r in floors.select("window_name", "metric", "__floor").collect()]


def rankable_activity(activity: DataFrame, floors: list[tuple[str, str, int]]) -> DataFrame:
    """Activity without what is below ``rank_floors``: such values are null, rows without any other are left out.

    The maxima of a paper that can rank in a window stay what they are, so the ranking does. ``d14`` ranks by ``total`` too.
    """
    least = {(name, metric): value for name, metric, value in floors}
    # A total is left out where both windows that rank by it have a floor, and it lies below both.
    for metric in {metric for _, metric in least}:
        both = [least.pop((name, metric), 0) for name in ("total", "d14")]
        least["total", metric] = min(both)
    names = [c for c in activity.columns if c not in ("repo_id", "metric")]
    kept = []
    for name in names:
        reached = F.col(name) > 0
        for metric, value in sorted((m, v) for (n, m), v in least.items() if n == name):
            reached = reached & ((F.col("metric") != metric) | (F.col(name) >= value))
        kept.append(F.when(reached, F.col(name)).alias(name))
    cut = activity.select("repo_id", "metric", *kept)
    return cut.where(F.coalesce(*(F.col(n) for n in names)).isNotNull())


def rank_bound(snap: dt.date, k: int = TOP_K, first_year: int = FIRST_YEAR) -> int:
    """The most rows one ranking snapshot can have."""
    return k * (len(activity_windows(snap, first_year)) + 1) * len(METRICS)


def activity_ranking(
    events: DataFrame,
    edges: DataFrame,
    papers: DataFrame,
    snap: dt.date,
    k: int = TOP_K,
    first_year: int = FIRST_YEAR,
    require_paper_first: bool = False,
) -> DataFrame:
    """The ranking table of one snapshot.

    Titles are attached after ranking, so a ranked id without a paper leaves a gap
    in the ranks. ``require_paper_first`` drops such ids before ranking instead.
    Only repositories that can make a paper rank meet the edges (``rank_floors``, a job of its own).
    """
    if require_paper_first:
        edges = edges.join(papers.select("arxiv_id"), "arxiv_id", "left_semi")
    per_repo, recent = repo_activity(events, snap, first_year), recent_papers(papers, snap)
    by_paper = linked_activity(edges, rankable_activity(per_repo, rank_floors(per_repo, edges, recent, k)))
    ranked = ranked_papers(by_paper, recent, k)
    return titled_ranking(ranked, papers, snap, rank_bound(snap, k, first_year))


def titled_ranking(ranked: DataFrame, papers: DataFrame, snap: dt.date, bound: int) -> DataFrame:
    """Ranked ids with the titles of their papers; the papers are scanned, not shuffled."""
    return (
        papers.select("arxiv_id", "title")
        .join(hint_bounded(ranked, bound), "arxiv_id")
        .select(
            F.lit(snap).alias("snapshot_date"), "window_name", "metric", "rank", "arxiv_id",
            "title", "metric_value",
        )
    )


def ranked_ids(ranking: DataFrame) -> DataFrame:
    return ranking.select("arxiv_id").distinct()


def ranking_bridge(edges: DataFrame, ranking: DataFrame, snap: dt.date, bound: int) -> DataFrame:
    """Distinct (paper, repository) pairs of the ranked papers.

    ``bound`` is the most ids the ranking can hold; up to the broadcast limit the
    edges are filtered in place and only the surviving pairs are shuffled.
    """
    pairs = edges.select("arxiv_id", "repo_id").join(
        hint_bounded(ranked_ids(ranking), bound), "arxiv_id", "left_semi"
    )
    return pairs.distinct().select(F.lit(snap).alias("snapshot_date"), "arxiv_id", "repo_id")


def repo_totals(activity: DataFrame) -> DataFrame:
    """Total per metric, one row per repository."""
    wide = pivot_metrics(activity.select("repo_id", "metric", "total"), ["repo_id"], "total", METRICS)
    return wide.select("repo_id", *(F.col(m).alias(f"{m}_total") for m in METRICS))


def paper_linked_repos(bridge: DataFrame, totals: DataFrame, repos: DataFrame) -> DataFrame:
    """Every repository of every ranked paper with its totals; absent totals are zero."""
    return (
        bridge.join(totals, "repo_id", "left")
        .join(repos.select("repo_id", "full_name", "owner"), "repo_id", "left")
        .select(
            "snapshot_date", "arxiv_id", "repo_id", "full_name", "owner",
            *(F.coalesce(f"{m}_total", F.lit(0)).alias(f"{m}_total") for m in METRICS),
        )
    )


def ordered_repos(linked: DataFrame, partitions: int | None = None) -> DataFrame:
    """The complete list of each paper's repositories as rows, with ``position`` from 1.

    A paper with very many repositories is sorted by as many tasks as its rows fill.
    """
    return numbered(linked, ["arxiv_id"], [F.col("star_total").desc(), F.col("repo_id").asc()], "position", partitions)


def paper_repo_chunks(ordered: DataFrame, size: int = REPO_CHUNK) -> DataFrame:
    """The same list as arrays of at most ``size``: rows ``arxiv_id``, ``chunk`` from 0, ``linked_repos``.

    A paper's chunks, one after the other, are its whole list.
    """
    fields = ["repo_id", "full_name", "owner", *(f"{m}_total" for m in METRICS)]
    entry = F.struct("position", F.struct(*fields).alias("repo"))
    chunk = F.floor((F.col("position") - 1) / size).cast("int").alias("chunk")
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["repo"])
    return ordered.groupBy("arxiv_id", chunk).agg(listed.alias("linked_repos"))


def paper_details(
    ranking: DataFrame, ordered: DataFrame, papers: DataFrame, snap: dt.date, bound: int, size: int = REPO_CHUNK
) -> DataFrame:
    """One detail row per ranked paper.

    Counts, maxima and sums cover all linked repositories. ``linked_repos`` is the first chunk of their list, which is
    all of it for a paper with at most ``size``; ``repo_chunks`` says how many ``paper_repo_chunks`` has.
    """
    sums = ordered.groupBy("arxiv_id").agg(
        F.count("*").cast("int").alias("repo_count"),
        *(
            f(f"{m}_total").alias(f"{m}_{n}")
            for m in METRICS
            for n, f in (("max", F.max), ("sum", F.sum))
        ),
    )
    ids = hint_bounded(ranked_ids(ranking), bound)
    texts = papers.select(
        "arxiv_id", "title", "abstract", "authors", "categories", "published_date", "datestamp"
    ).join(ids, "arxiv_id", "left_semi")
    first = paper_repo_chunks(ordered.where(F.col("position") <= size), size).drop("chunk")
    empty = F.from_json(F.lit("[]"), f"array<{LINKED_REPO}>")
    return (
        ranked_ids(ranking)
        .join(texts, "arxiv_id", "left")
        .join(sums, "arxiv_id", "left")
        .join(first, "arxiv_id", "left")
        .select(
            F.lit(snap).alias("snapshot_date"), "arxiv_id", "title", "abstract", "authors",
            "categories", "published_date", "datestamp",
            F.coalesce("linked_repos", empty).alias("linked_repos"),
            F.coalesce(F.ceil(F.col("repo_count") / size).cast("int"), F.lit(0)).alias("repo_chunks"),
            F.lit(None).cast("string").alias("openalex_data"),
            F.coalesce("repo_count", F.lit(0)).alias("repo_count"),
            *(
                F.coalesce(f"{m}_{n}", F.lit(0)).alias(f"{m}_{n}")
                for m in METRICS
                for n in ("max", "sum")
            ),
        )
    )


def repo_details(
    bridge: DataFrame, totals: DataFrame, repos: DataFrame, papers: DataFrame, snap: dt.date, bound: int
) -> DataFrame:
    """One detail row per repository of a ranked paper.

    A repository's list holds ranked papers only, so ``bound`` limits its length.
    """
    ids = bridge.select("arxiv_id").distinct()
    titles = papers.select("arxiv_id", "title").join(hint_bounded(ids, bound), "arxiv_id", "left_semi")
    entry = F.struct(
        F.col("title").isNull().alias("last"), F.col("title"), F.col("arxiv_id")
    )  # order: titled first, by title, then id
    lists = (
        bridge.select("arxiv_id", "repo_id")
        .join(hint_bounded(titles, bound), "arxiv_id", "left")
        .groupBy("repo_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("l"))
        .select(
            "repo_id",
            F.transform(
                "l", lambda x: F.struct(x["arxiv_id"].alias("arxiv_id"), x["title"].alias("title"))
            ).alias("linked_papers"),
        )
    )
    return (
        lists.join(totals, "repo_id", "left")
        .join(repos.select("repo_id", "full_name", "owner"), "repo_id", "left")
        .select(
            F.lit(snap).alias("snapshot_date"), "repo_id", "full_name", "owner",
            *(F.coalesce(f"{m}_total", F.lit(0)).alias(f"{m}_total") for m in METRICS),
            "linked_papers",
        )
    )
