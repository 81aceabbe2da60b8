"""The registered queries: each operator over the given tables, with its SQL."""

from litpulse.catalog import ingest, ledgers, published, rankings, scalars, writes  # noqa: F401
from litpulse.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
