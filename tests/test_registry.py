"""A sample of registered queries against their oracle on the smallest tables."""

import os

import duckdb
import pytest

import check
from sitewise.plans import catalog
from sitewise.plans.registry import ORACLE, QUERIES
from sitewise.plans.views import TABLES

DATA = "/root/testdata/sf0.001"
SAMPLE = ["ca06", "ca07", "ag04", "ca09", "ag12", "wn01", "ag19", "jn19", "tr02", "sc22", "ps15", "src10"]


def test_registry_is_complete():
    catalog.load()
    assert len(QUERIES) > 230
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) <= {"ps17", "ca12_mc", "ps13_test", "sc16", "flt14"}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")
@pytest.mark.parametrize("key", SAMPLE)
def test_query_equals_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = QUERIES[key](spark, DATA)
    rel = con.sql(ORACLE[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert check.rows(df.columns, df.collect()) == check.rows(rel.columns, rel.fetchall())
