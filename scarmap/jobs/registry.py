"""All queries of the burnt-area part, with their SQL."""

from __future__ import annotations

#: The query that entry() runs.
FLAGSHIP = "k1_top_fires"


def _modules() -> list:
    from scarmap.jobs import file_queries, fire_queries, record_queries, zone_queries

    return [fire_queries, record_queries, file_queries, zone_queries]


def queries() -> dict:
    return {k: q for m in _modules() for k, q in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: q for m in _modules() for k, q in m.ORACLE.items()}
