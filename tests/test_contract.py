"""The registered queries against DuckDB at the smallest scale."""

import pytest

import __spark_entry__ as contract
from check import database, normal

ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return database(sf)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and len(df.columns) == 12


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, sf, name):
    df = contract.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert got
        return
    cur = duck.execute(ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert normal(got, df.columns) == normal(cur.fetchall(), names)
