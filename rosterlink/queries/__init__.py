"""Registered queries of the reference's own operators: callables and their DuckDB SQL."""

from __future__ import annotations


def all_queries() -> tuple[dict, dict]:
    """``(queries, oracle SQL)`` of every query module."""
    from rosterlink.queries import records, roster

    parts = (roster, records)
    return {k: v for p in parts for k, v in p.QUERIES.items()}, {k: v for p in parts for k, v in p.ORACLE.items()}
