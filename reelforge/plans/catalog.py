"""All queries of the library."""

from __future__ import annotations

from reelforge.plans import queries_arrays, queries_clips, queries_files, queries_lineage, queries_rules, queries_scalars, queries_sequences  # noqa: F401
from reelforge.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
