"""Full-text records: profiles and batched reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litpulse.schemas import FULL_TEXT_RECORD
from litpulse.session import materialise
from litpulse.sources.tables import union_all


def document_profile(records: DataFrame, raw: str, *keep: str) -> DataFrame:
    """Shape of each JSON document; text (or UTF-8 bytes) that is no JSON object is dropped."""
    text = F.col(raw)
    if dict(records.dtypes)[raw] == "binary":
        text = F.decode(raw, "UTF-8")
    parsed = records.select(*keep, text.alias("raw")).where(F.json_object_keys("raw").isNotNull())
    doc = parsed.select(
        *keep, "raw", F.from_json("raw", FULL_TEXT_RECORD).alias("d")
    )

    def n(c: str) -> Column:
        return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("bigint")

    return doc.select(
        *keep,
        "d.paper_id",
        F.json_object_keys("raw").alias("top_keys"),
        F.col("d.metadata.title").alias("title"),
        F.col("d.metadata.categories").alias("categories"),
        F.col("d.metadata.update_date").alias("update_date"),
        n("d.metadata.authors_parsed").alias("n_authors"),
        n("d.metadata.versions").alias("n_versions"),
        F.coalesce(F.length("d.abstract.text"), F.lit(0)).cast("bigint").alias("abstract_chars"),
        n("d.sections").alias("n_sections"),
        F.map_keys("d.sections").alias("section_names"),
        n("d.bib_entries").alias("n_bib"),
        n("d.ref_entries").alias("n_ref"),
        F.octet_length("raw").cast("bigint").alias("n_bytes"),
        (F.octet_length("raw") / 1024).alias("kilobytes"),
    )


def path_profile(records: DataFrame, raw: str) -> DataFrame:
    """Every path of free-form JSON records with its types: ``path, kind, n_values, n_records, least_chars, most_chars``.

    ``$`` is the record, ``.name`` a field, ``[]`` the elements of an array; ``kind`` is the type in lower case, ``void`` for a JSON null;
    ``n_records`` counts the records a path and type occur in, the lengths are those of values as text (null for nested ones).
    Text that is no JSON has kind ``broken`` at ``$``; a null record is left out. Fields are taken as they come, no
    schema is given. Records are walked one level of nesting at a time, each level written before the next is taken from
    it, so a deep or wide record is rows, never one large value in a task.
    """
    spark, shredding = records.sparkSession, "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(shredding)
    # Columns inferred for stored variants may widen numbers; the types are what is asked for here.
    spark.conf.set(shredding, "false")
    try:
        return _path_profile(spark, records, raw)
    finally:
        spark.conf.set(shredding, before)


def _path_profile(spark: SparkSession, records: DataFrame, raw: str) -> DataFrame:
    text = F.decode(raw, "UTF-8") if dict(records.dtypes)[raw] == "binary" else F.col(raw)
    level = records.select(F.monotonically_increasing_id().alias("record"), F.lit("$").alias("path"), F.try_parse_json(text).alias("value"), text.alias("raw"))
    level = materialise(level.where(F.col("raw").isNotNull()).select("record", "path", "value", F.col("value").isNull().alias("broken")), "paths")
    found = []
    while True:
        kind = F.lower(F.regexp_extract(F.schema_of_variant("value"), r"^[A-Z]+", 0))
        kinds = level.select("record", "path", F.when(F.col("broken"), "broken").otherwise(kind).alias("kind"), "value")
        nested = F.col("kind").isin("object", "array")
        chars = F.length(F.when(~nested, F.try_variant_get("value", "$", "string")))
        # Repeats within a record combine first, so the count of records needs no list of them.
        each = kinds.groupBy("path", "kind", "record").agg(F.count(F.lit(1)).alias("n"), F.min(chars).alias("low"), F.max(chars).alias("high"))
        found.append(
            each.groupBy("path", "kind").agg(
                F.sum("n").alias("n_values"), F.count(F.lit(1)).alias("n_records"), F.min("low").alias("least_chars"), F.max("high").alias("most_chars")
            )
        )
        inner = spark.sql(
            "SELECT record, path || CASE WHEN kind = 'array' THEN '[]' ELSE '.' || key END AS path, child AS value, FALSE AS broken"
            " FROM {kinds}, LATERAL variant_explode(value) AS x(pos, key, child) WHERE kind IN ('object', 'array')",
            kinds=kinds,
        )
        level = materialise(inner, "paths")
        if level.isEmpty():
            return union_all(found)


def in_batches(
    df: DataFrame, size: int, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Apply ``work`` to batches of at most ``size`` rows inside each partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), size):
                yield work(frame.iloc[start : start + size])

    return df.mapInPandas(run, schema)
