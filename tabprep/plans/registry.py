"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from . import cleaning, governing, intake, loading, querying, reading

MODULES = (cleaning, reading, loading, querying, intake, governing)


def queries() -> dict:
    return {k: q for m in MODULES for k, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.ORACLES.items()}
