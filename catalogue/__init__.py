"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from catalogue import correlation, counts, lake, raw, scalars, streams, windows  # noqa: F401
from catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
