"""Every registered query of the reference's operators against its DuckDB statement on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__
from framelens.plans.catalog import QUERIES
from framelens.plans.statements import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_statement(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(v) for v in r)) for r in df.select(columns).collect())
    relation = duck.sql(ORACLE_SQL[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    assert got == sorted(repr(tuple(plain(r[i]) for i in places)) for r in relation.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_statement_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 3


def test_registry_holds_the_catalogue():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
