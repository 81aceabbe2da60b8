"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Text without white space at either end; linear in the text length."""
    return F.trim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def collapse_whitespace(c: Column) -> Column:
    """Every run of white space becomes one blank, none at the ends."""
    return strip(F.regexp_replace(c, f"[{WHITESPACE}]+", " "))


def owner_of(full_name: Column) -> Column:
    """The part of ``owner/name`` before the first slash."""
    return F.substring_index(full_name, "/", 1)


def name_of(full_name: Column) -> Column:
    """All that follows the first slash; empty when there is none."""
    at = F.instr(full_name, "/")
    return F.when(at > 0, F.substring(full_name, at + 1, F.length(full_name))).when(
        full_name.isNotNull(), F.lit("")
    )


def clip(c: Column, n: int) -> Column:
    """An error text cut to its first ``n`` characters."""
    return F.substring(c, 1, n)


def is_missing_text(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def is_missing_array(c: Column) -> Column:
    return c.isNull() | (F.size(c) == 0)


def is_missing_number(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def is_missing(c: Column, type_name: str) -> Column:
    """Missing-value test by kind: null, blank text, empty array, NaN."""
    if type_name == "string":
        return is_missing_text(c)
    if type_name.startswith(("array", "map")):
        return is_missing_array(c)
    if type_name in ("double", "float"):
        return is_missing_number(c)
    return c.isNull()
