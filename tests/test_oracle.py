"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registry
from check import rows_of
from waybill.checks.queries import QUERIES

from pathlib import Path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0 and rows_of(got) == rows_of(want)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
