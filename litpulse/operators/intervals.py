"""Joins of points and intervals by equality on the nodes of a tree over days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litpulse.operators.topk import top_k

#: A node of a level spans ``FAN ** level`` days; the top level's span about 90 years each.
FAN, LEVELS = 8, 6


def _node(level: Column | int, number: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), number.cast("bigint").alias("number"))


def point_nodes(day: Column) -> Column:
    """The nodes a day lies in, one a level; null for a null day."""
    at = F.unix_date(day)
    return F.when(day.isNotNull(), F.array(*(_node(k, F.floor(at / F.lit(FAN**k))) for k in range(LEVELS))))


def span_nodes(first: Column, last: Column) -> Column:
    """The fewest nodes that together hold the days from ``first`` to ``last`` and no other.

    A day of the interval lies in exactly one of them. Empty when ``first`` is after ``last``; null if one is null.
    """
    begin, end = F.unix_date(first).cast("bigint"), F.unix_date(last).cast("bigint") + 1
    # The whole nodes of a level, from the first that begins inside to the last that ends inside.
    inner = [(F.ceil(begin / F.lit(FAN**k)), F.floor(end / F.lit(FAN**k))) for k in range(LEVELS)]

    def between(level: int, low: Column, high: Column) -> Column:
        numbers = F.sequence(low, F.greatest(low, high - 1))
        return F.when(low < high, F.transform(numbers, lambda n: _node(level, n))).otherwise(F.array().cast("array<struct<level:int,number:bigint>>"))

    parts = []
    for k, (low, high) in enumerate(inner):
        if k + 1 == LEVELS:
            parts.append(between(k, low, high))
            continue
        up_low, up_high = inner[k + 1]
        # Without a whole node above, all of this level's; else those on either side of what the level above holds.
        split = up_low < up_high
        parts.append(between(k, low, F.when(split, up_low * FAN).otherwise(high)))
        parts.append(between(k, F.when(split, up_high * FAN).otherwise(high), high))
    return F.when(first.isNotNull() & last.isNotNull(), F.concat(*parts))


def join_spans(points: DataFrame, day: str, spans: DataFrame, first: str, last: str) -> DataFrame:
    """Pairs of a point and an interval that holds its day, both ends included; an inner join.

    A point has ``LEVELS`` rows in the shuffle, an interval at most ``2 * (FAN - 1)`` a level, and a pair meets in one
    node only, so nothing has to be removed afterwards. Neither side is collected or assumed to be small; a
    node with very many points is split by the adaptive skew join. Null days, null ends and ends before
    their beginning pair with nothing. Column names of the two sides must differ.
    """
    at = points.withColumn("__node", F.explode(point_nodes(F.col(day))))
    over = spans.withColumn("__span", F.explode(span_nodes(F.col(first), F.col(last))))
    same = (F.col("__node.level") == F.col("__span.level")) & (F.col("__node.number") == F.col("__span.number"))
    return at.join(over, same).drop("__node", "__span")


def top_in_spans(points: DataFrame, day: str, spans: DataFrame, first: str, last: str, order: Sequence[Column], k: int) -> DataFrame:
    """Pairs as of ``join_spans``, but of each interval only the first ``k`` points in ``order``.

    The nodes of an interval have no day in common, so its first ``k`` points are among the first ``k`` of each node, and
    those among the first ``k`` of each day. A day and then a node pass on ``k`` points at most, and equal intervals meet them once,
    so the pairs grow with the intervals, whatever the points; ``order`` should end in a key. The points' columns follow the intervals'.
    """
    of_day = top_k(points.where(F.col(day).isNotNull()), [day], order, k).drop("rank")
    of_node = top_k(of_day.withColumn("__node", F.explode(point_nodes(F.col(day)))), ["__node"], order, k).drop("rank")
    different = spans.select(F.col(first).alias("__first"), F.col(last).alias("__last")).distinct()
    over = different.withColumn("__span", F.explode(span_nodes(F.col("__first"), F.col("__last"))))
    same = (F.col("__node.level") == F.col("__span.level")) & (F.col("__node.number") == F.col("__span.number"))
    found = top_k(of_node.join(over, same).drop("__node", "__span"), ["__first", "__last"], order, k).drop("rank")
    return spans.join(found, (F.col(first) == F.col("__first")) & (F.col(last) == F.col("__last"))).drop("__first", "__last")
