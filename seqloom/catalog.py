"""All registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from .plans import more_bindings, record_bindings  # noqa: F401  register their queries
from .plans.bindings import ORACLE_SQL, QUERIES

FLAGSHIP = "exn50"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
