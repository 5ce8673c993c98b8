"""All queries of the library and their SQL."""

from __future__ import annotations

from quarry.plans import corpus, ops


def queries() -> dict:
    return corpus.Q | ops.Q


def oracle_sql() -> dict[str, str]:
    return corpus.SQL | ops.SQL
