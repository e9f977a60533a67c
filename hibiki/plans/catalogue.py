"""All core queries and their SQL, by name."""

from __future__ import annotations

from . import corpus_queries, detail_queries, index_queries, ledger_queries  # noqa: F401  (they register themselves)
from .registry import ORACLE, QUERIES  # noqa: F401
