"""All registered queries of this package."""

from litpulse.llm import queries_arrow, queries_native, queries_text  # noqa: F401
from litpulse.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
