"""All queries over the driver's tables, by name, and their DuckDB counterparts."""

from __future__ import annotations

from tidemark.plans import oracle
from tidemark.plans.queries import QUERIES

ORACLE: dict[str, str] = {k: v for k, v in oracle.ORACLE.items() if k in QUERIES}
