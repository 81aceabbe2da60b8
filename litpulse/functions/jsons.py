"""JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from litpulse.schemas import LINKED_REPO


def to_json_full(c: Column) -> Column:
    """JSON text that keeps null fields."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def json_or_null(arr: Column) -> Column:
    """JSON text of an array; an empty array is stored as null."""
    return F.when(F.size(arr) > 0, to_json_full(arr))


def to_ints(arr: Column) -> Column:
    """Array of text to array of bigint; what does not parse is null."""
    return F.transform(arr, lambda x: x.try_cast("bigint"))


def bounded_map_values(text: Column, value_type: str) -> Column:
    return F.map_values(F.from_json(text, f"map<string,{value_type}>"))


def linked_repo_array(text: Column) -> Column:
    """A repository list stored as a JSON array or object (its values); bad text is empty."""
    head = F.substring(F.ltrim(text), 1, 1)
    parsed = F.when(head == "[", F.from_json(text, f"array<{LINKED_REPO}>")).when(
        head == "{", bounded_map_values(text, LINKED_REPO)
    )
    return F.coalesce(parsed, F.from_json(F.lit("[]"), f"array<{LINKED_REPO}>"))
