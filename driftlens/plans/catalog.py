"""Queries over the driver's tables, one for each operator, and the SQL they are checked against."""

from __future__ import annotations

from . import schedule_queries, text_queries

QUERIES: dict = {**schedule_queries.QUERIES, **text_queries.QUERIES}
ORACLE_SQL: dict[str, str] = {**schedule_queries.ORACLE_SQL, **text_queries.ORACLE_SQL}
