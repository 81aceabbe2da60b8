"""Mixing sources to target weights: repetition rates per source, copies per document.

Words per source are summed once; a source's rate is its target over its words.
Each document is emitted floor(rate) times and once more with the probability of
the fraction, drawn from a hash of its id, so that reruns and retried tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litpulse.llm.common import free_name, word_count
from litpulse.session import materialise

#: Weights of the sources in code-point order, null last, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix in hundredths of all words, and copies of a source at most.
SHARE_PERCENT = 150
MOST_TIMES = 2
#: Seed of the draws.
SEED = "mix-1"
#: Hexadecimal digits of a draw: 52 bits, exact in a double.
DIGITS = 13


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id; from the text where the id is null."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), text, F.lit("")))
    digits = F.substring(F.md5(key.cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(16**DIGITS))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, most_times=MOST_TIMES) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Targets are proportional to the weights up to ``most_times`` the source's
    size; what a full source cannot take is shared anew among the others. With the
    sources ordered by capacity over weight, the full ones are a prefix, so one
    running sum finds the level; no loop. Behind the true level the computed ones fall. The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    per = per.withColumn("weight", F.element_at(cycle, (place % len(weights)) + 1).cast("bigint"))
    per = per.withColumn("room", F.col("source_size") * most_times)
    by_room = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = (
        per.withColumn("wanted", F.sum("source_size").over(every) * share_percent)
        .withColumn("full", F.coalesce(F.sum("room").over(before), F.lit(0)) * 100)
        .withColumn("open", F.sum("weight").over(after))
    )
    level = (F.col("wanted") - F.col("full")).cast("double") / (F.col("open") * 100).cast("double")
    fits = level <= F.col("room").cast("double") / F.col("weight").cast("double")
    per = per.withColumn("level", F.max(F.when(fits, level)).over(every))
    # A share beyond all room leaves no level: every source is then full.
    target = F.least(F.col("room").cast("double"), F.col("level") * F.col("weight").cast("double"))
    return per.select("source", "source_size", target.alias("target"))


def copies_of(u: Column, rate: Column) -> Column:
    """floor(rate), and one more where the draw falls into the fraction."""
    return F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)


def with_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    The sizes are read once for the sums and once for the copies. The table of
    sources is written first: the planner then sees its true size, broadcasts it
    when it is small and otherwise joins by shuffle, splitting a hot source.
    Null text: size 0. Null source: a source of its own, last. Sources without a
    word: rate 0. Rows that repeat an id draw alike. Empty table: no rows.
    Needs ``doc_id, text, source``; other columns pass through, but those named like the new ones are replaced.
    """
    sizes = docs.select("source", word_count("text").alias("size"))
    targets = materialise(source_targets(sizes, **options), "targets")
    key = free_name(docs, "mix_key")
    targets = targets.select(F.col("source").alias(key), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    joined = docs.join(targets, docs["source"].eqNullSafe(targets[key]), "left").drop(key)
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size").cast("double")).otherwise(0.0)
    return joined.withColumn("mix_size", word_count("text")).withColumn("mix_copies", copies_of(draw(F.col("doc_id"), F.col("text")), rate).cast("bigint"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as it is taken, with its own columns, whatever their names.

    Rows travel as one value, so columns that are called like helper columns come out as they went in. Nulls, repeated
    rows and empty tables as in ``with_copies``.
    """
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    mixed = with_copies(docs.select(own, "doc_id", "text", "source"), **options)
    # One output row per copy: the element itself is not kept.
    return mixed.where("mix_copies > 0").select("row", F.explode(F.expr("sequence(1L, mix_copies)"))).select("row.*")
