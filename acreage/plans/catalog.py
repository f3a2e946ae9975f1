"""Every query of the library, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from acreage.plans import cleaning_queries, kpi_queries, merge_queries, profile_queries, raw_queries, system_queries, warehouse_queries

QUERIES: dict = {}
ORACLES: dict = {}
for part in (kpi_queries, merge_queries, cleaning_queries, profile_queries, warehouse_queries, system_queries, raw_queries):
    QUERIES |= part.QUERIES
    ORACLES |= part.ORACLES
