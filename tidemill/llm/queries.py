"""All queries of this subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from tidemill.llm import audit, decontaminate, language, licenses, manifest, neardup, pieces, quality, secrets, sharding, simhash, topk, warc  # noqa: F401
from tidemill.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
