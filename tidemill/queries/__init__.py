"""Registered queries: each operator on whole test tables, with the SQL that
must give the same result."""

from tidemill.queries.registry import ORACLES, QUERIES
from tidemill.queries import decode, enrich, events, keyed, keys, streams, tables, text  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
