"""Every query of the engine over the test tables, with the equivalent SQL."""

from __future__ import annotations

from .assembly import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
