"""One batch of papers into the archive and the paper table, together or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litpulse.functions.jsons import json_or_null
from litpulse.schemas import PAPERS, VERSION
from litpulse.session import materialise
from litpulse.sources.keyed import BUCKETS, SEQUENCE, Fold, KeyedTable, papers_table
from litpulse.sources.publishing import Publication

ARCHIVE = "archive"
#: Columns of a paper in order; the table keeps lists as JSON text, the archive as JSON.
COLUMNS = [c.split()[0] for c in PAPERS.replace(VERSION, "").split(",")]
LISTS = ("set_specs", "versions")


def _archived() -> Fold:
    return Fold(["arxiv_id", "month"], last=[c for c in COLUMNS if c != "arxiv_id"])


def publication_month(published: str) -> Column:
    """``YYYY-MM`` of an ISO date text; null for shorter text, which has no place in the archive."""
    return F.when(F.length(published) >= 7, F.substring(published, 1, 7))


def paper_store(publication: Publication, buckets: int = BUCKETS) -> KeyedTable:
    """The paper table: all columns, lists as JSON text, empty ones as null."""
    return papers_table(publication, COLUMNS, buckets)


def ingest_papers(
    publication: Publication, batch: DataFrame, sequence: str, source: str | None = None, number: int | None = None, buckets: int = BUCKETS
) -> bool:
    """Put a batch of papers (all columns, and ``sequence``) into the archive and the paper table in one commit.

    The record with the highest sequence counts, in both, whichever batch brings it; rows without an id are left
    out, undated ones go to the table alone. A batch of a source that was committed is skipped (false), so a
    repetition changes nothing; one that failed between the two has published neither and is done anew.
    The archive rewrites the months only in which the batch has a record that is not older than the stored one; the
    table gets one small file a bucket.
    """
    if source is not None and publication.holds(source, number):
        return False
    rows = batch.where(F.col("arxiv_id") != "").withColumn("month", publication_month("published_date"))
    rules = _archived()
    rows = materialise(rules.fold(rules.state(rows, sequence)), "papers_batch")
    text = {c: json_or_null(F.col(c)) for c in LISTS}
    dated = rows.where(F.col("month").isNotNull())
    with publication.commit(source, number) as commit:
        paper_store(publication, buckets).add(commit, rows.withColumns(text), SEQUENCE)
        months = [r[0] for r in dated.select("month").distinct().collect()]  # calendar months, a short list
        known = publication.parts(ARCHIVE)
        if any(m in known for m in months):
            stored = publication.read(ARCHIVE, months, schema=dated.schema)
            later = stored.select("arxiv_id", "month", F.col(SEQUENCE).alias("stored_at"))
            older = F.col("stored_at").isNotNull() & F.coalesce(F.col(SEQUENCE) < F.col("stored_at"), F.lit(True))
            on = [dated["arxiv_id"] == later["arxiv_id"], dated["month"] == later["month"], older]
            dated = materialise(dated.join(later, on, "left_anti"), "papers_to_store")
            months = [r[0] for r in dated.select("month").distinct().collect()]
        if months:
            merged = dated
            if any(m in known for m in months):
                merged = rules.fold(publication.read(ARCHIVE, months, schema=dated.schema).unionByName(dated))
            commit.replace(ARCHIVE, merged, F.col("month"), months, format="json")
    return True
