"""The registered queries: each one next to the SQL that gives the same rows."""

from registry.book import QUERIES, SQL
from registry import extensions, loads, payloads, quality, reports, star  # noqa: F401  (they register themselves)

__all__ = ["QUERIES", "SQL"]
