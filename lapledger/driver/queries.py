"""All registered queries."""

from __future__ import annotations

from lapledger.driver import files, jobs, published, summaries, windows  # noqa: F401
from lapledger.driver.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
