"""Whole runs: build, check and publish all tables of one ranking version."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litpulse.operators.constraints import output_constraints
from litpulse.operators.quality import (
    citation_report,
    require_contiguous,
    require_past,
    require_rows,
    row_counts,
)
from litpulse.plans import activity, citations
from litpulse.session import materialise
from litpulse.sources.publishing import Publication
from litpulse.sources.sinks import in_rank_order


def build_activity_snapshot(
    events: DataFrame,
    edges: DataFrame,
    papers: DataFrame,
    repos: DataFrame,
    snap: dt.date,
    out: str,
    k: int = activity.TOP_K,
    first_year: int = activity.FIRST_YEAR,
) -> DataFrame:
    """Write ranking, bridge, repository lists, paper and repository details below ``out``; return their row counts.

    Each table is built once in the shared scratch folder and read back by the next
    step, so nothing is computed twice and a lost executor costs no more than the
    running step. Only when all of them have passed the checks are they published, by one commit
    of ``Publication(spark, out)``, which also checks the constraints of every table as it writes it: a run that
    fails, at whatever point, leaves the tables of the last good one.
    """
    spark = events.sparkSession
    bound = activity.rank_bound(snap, k, first_year)
    per_repo = materialise(activity.repo_activity(events, snap, first_year), "repo_activity")
    require_rows(repo_activity=per_repo)
    recent = activity.recent_papers(papers, snap)
    by_paper = activity.linked_activity(edges, activity.rankable_activity(per_repo, activity.rank_floors(per_repo, edges, recent, k)))
    ranked = activity.ranked_papers(by_paper, recent, k)
    ranking = materialise(activity.titled_ranking(ranked, papers, snap, bound), "ranking")
    require_rows(ranking=ranking)
    bridge = materialise(activity.ranking_bridge(edges, ranking, snap, bound), "bridge")
    totals = activity.repo_totals(per_repo)
    linked = activity.ordered_repos(activity.paper_linked_repos(bridge, totals, repos))
    linked = materialise(linked, "paper_linked_repos")
    built = {
        "repo_activity": per_repo,
        "bridge": bridge,
        "paper_linked_repos": linked,
        "paper_repo_chunks": materialise(activity.paper_repo_chunks(linked), "paper_repo_chunks"),
        "paper_details": materialise(
            activity.paper_details(ranking, linked, papers, snap, bound), "paper_details"
        ),
        "repo_details": materialise(
            activity.repo_details(bridge, totals, repos, papers, snap, bound), "repo_details"
        ),
    }
    require_rows(**built)
    publication, must = Publication(spark, out), output_constraints(k)
    with publication.commit() as commit:
        for name, df in {**built, "ranking": in_rank_order(ranking)}.items():
            commit.overwrite(name, df, constraints=must.get(name))
    tables = ("ranking", "bridge", "paper_details", "repo_details")
    return row_counts({t: publication.read(t) for t in tables})


def build_citation_version(
    works: DataFrame,
    papers: DataFrame,
    as_of: dt.date,
    today: dt.date,
    out: str,
    k: int = citations.TOP_K,
    status: str = "completed",
) -> DataFrame:
    """Write ranking and details of one version below ``out``; return the check report.

    Other versions stay as they are; a rerun replaces its own version. Both tables are checked before
    one commit of ``Publication(spark, out)`` publishes them together: a version without rows or with gaps raises,
    and what was published before stays. ``status`` is the state the task ledger holds.
    """
    require_past(as_of, today)
    publication = Publication(works.sparkSession, out)
    ranking = materialise(citations.citation_ranking(works, papers, as_of, k), "citation_ranking")
    require_rows(ranking=ranking)
    require_contiguous(ranking, k)
    details = materialise(citations.citation_details(ranking, works, papers, as_of, k), "citation_details")
    require_rows(details=details)
    version, must = F.col("as_of_date"), output_constraints(k)
    built = {"citation_ranking": ranking, "citation_details": details}
    with publication.commit() as commit:
        for name, df in built.items():
            commit.replace(name, df, version, [as_of], required=True, constraints=must[name])
    stored = [publication.read(name, [as_of]) for name in built]
    return citation_report(*stored, F.lit(status), k)
