"""All queries of the engine by name, and the SQL that their results are held against."""

from __future__ import annotations

from plumbline.plans import analytics, fields, records, upkeep

QUERIES: dict = {**analytics.QUERIES, **records.QUERIES, **upkeep.QUERIES, **fields.QUERIES}
ORACLE_SQL: dict[str, str] = {**analytics.ORACLE_SQL, **records.ORACLE_SQL, **upkeep.ORACLE_SQL, **fields.ORACLE_SQL}
