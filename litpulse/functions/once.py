"""Keeping costly expressions from being evaluated again by pushed filters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column) -> Column:
    """The value as generator output, one row in, one row out.

    Catalyst copies an expression into every filter it pushes below the projection
    that computes it. It never pushes a filter below the generator whose output it
    tests, so a parsed value stays parsed once. One use per ``select``.
    """
    return F.explode_outer(F.array(c))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is used several times and computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
