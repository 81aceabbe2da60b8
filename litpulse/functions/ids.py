"""Paper identifiers in free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The identifier patterns, in order of precedence.
ID_PATTERNS = (
    ("url", r"(?iU)arxiv\.org/(?:abs|pdf)/(\d{4}\.\d{4,5}|[a-z][a-z.-]*/\d{7})(?:v\d+)?"),
    ("inline", r"(?iU)arXiv[:\s]+(\d{4}\.\d{4,5}|[a-z][a-z.-]*/\d{7})(?:v\d+)?"),
    ("bibtex", r"""(?iU)eprint\s*=\s*[{"'](\d{4}\.\d{4,5}|[a-z][a-z.-]*/\d{7})"""),
)


def _tagged(ids: Column, fmt: str) -> Column:
    return F.transform(ids, lambda x: F.struct(x.alias("arxiv_id"), F.lit(fmt).alias("format")))


def with_paper_ids(df: DataFrame, text: str, out: str = "ids") -> DataFrame:
    """Add ``out: array<struct<arxiv_id, format>>``, each id once, in order of discovery.

    An id belongs to the first pattern that finds it. Null or empty text gives an
    empty array. The matches are kept in columns of their own so that each
    pattern scans the text once.
    """
    cols = [f"__{fmt}" for fmt, _ in ID_PATTERNS]
    found = df.withColumns(
        {
            c: F.array_distinct(
                F.coalesce(
                    F.regexp_extract_all(F.col(text), F.lit(pattern), 1),
                    F.array().cast("array<string>"),
                )
            )
            for c, (_, pattern) in zip(cols, ID_PATTERNS)
        }
    )
    parts, seen = [], None
    for c, (fmt, _) in zip(cols, ID_PATTERNS):
        fresh = F.col(c) if seen is None else F.array_except(F.col(c), seen)
        seen = F.col(c) if seen is None else F.array_union(seen, F.col(c))
        parts.append(_tagged(fresh, fmt))
    return found.withColumn(out, F.concat(*parts)).drop(*cols)


def paper_id_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per text and id: the kept columns, ``arxiv_id`` and ``format``."""
    return (
        with_paper_ids(df, text, "__ids")
        # An inner explode would imply a filter that scans the text a second time.
        .select(*keep, F.explode_outer("__ids").alias("__id"))
        .where(F.col("__id").isNotNull())
        .select(*keep, "__id.arxiv_id", "__id.format")
    )
