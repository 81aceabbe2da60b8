"""Paper and repository ranking as plain Spark DataFrame functions."""

from litpulse.session import build_session

__all__ = ["build_session"]
