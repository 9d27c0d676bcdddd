"""Registered queries against their check statements on the smallest tables."""

import duckdb
import pytest
from compare import TABLES, canonical, ok_kind

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_statement(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    result = con.execute(CHECKS[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert {f.name for f in df.schema} == set(kinds)
    assert all(ok_kind(f.dataType.simpleString(), kinds[f.name]) for f in df.schema)
    got, want = canonical(df.toPandas()), canonical(result.df())
    assert len(got) == len(want)
    assert got.equals(want)


def test_entry(spark):
    assert entry.entry(spark).count() == 200


def test_every_query_is_registered():
    assert set(CHECKS) <= set(entry.queries())
