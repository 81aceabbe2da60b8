"""Row numbers without a task per group: range partitions, then prefix sums of their counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litpulse.session import materialise

#: A row's running number holds its partition above these bits.
_PARTITION_BITS = 33


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[Column], out: str, partitions: int | None = None) -> DataFrame:
    """``row_number()`` per ``group`` in ``order`` as a bigint column ``out``; no ``group`` numbers all rows.

    Rows are dealt by ranges of group and order, with bounds that Spark samples, so a group with a third of
    all rows lies in as many partitions as it fills. Sorted rows get a running number; a group's run in a
    partition has a first number and a length, and the lengths of the runs before it are what its rows'
    numbers start from. There is one run a group, and one more for every bound that cuts it. Null groups are
    a group; rows equal in ``order`` are numbered in some order and lie in one partition, so ``order`` should end in a key. ``partitions`` fixes how many there are.
    """
    by = [F.col(c) for c in group]
    dealt = rows.repartitionByRange(partitions, *by, *order) if partitions else rows.repartitionByRange(*by, *order)
    placed = materialise(dealt.sortWithinPartitions(*by, *order).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("__part", F.shiftright("__at", _PARTITION_BITS))
    runs = placed.groupBy(*group, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    names = {c: f"__group{k}" for k, c in enumerate([*group, "__part"])}
    runs = runs.select(*(F.col(c).alias(n) for c, n in names.items()), (F.coalesce(before, F.lit(0)) - F.col("__first") + 1).alias("__from"))
    same = F.lit(True)
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    return placed.join(runs, same).select(*rows.columns, (F.col("__at") + F.col("__from")).alias(out))
