"""Every registered query against its SQL on DuckDB, over whole tables."""

import math

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from tabprep.plans import registry
from tabprep.plans.inputs import TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


def _value(v):
    """Values by type: whole numbers and texts exactly, floats to nine digits after the point, NaN unlike null."""
    if isinstance(v, bool) or v is None or isinstance(v, (str, int)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return [_value(x) for x in v]
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [repr(tuple(_value(r[i]) for i in order)) for r in rows]


#: Queries whose order is part of the answer.
ORDERED = ("tbl_preview_limit", "doc_find_limited")


def test_every_query_has_a_check():
    assert set(registry.queries()) == set(registry.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1500


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SMALL)
    result = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    found, wanted = _rows(df.columns, df.collect()), _rows(columns, result.fetchall())
    assert (found if name in ORDERED else sorted(found)) == (wanted if name in ORDERED else sorted(wanted))
