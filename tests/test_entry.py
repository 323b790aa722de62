"""Every registered query against its SQL on the smallest test tables."""

import datetime
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def normalized(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


# The SQL type each Spark type must meet.
SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


BASE = {name for r in contract._REGISTRIES for name in r.queries}


def test_every_query_has_sql():
    assert BASE == {name for r in contract._REGISTRIES for name in r.sql}


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) & BASE))
def test_query_matches_sql(spark, duck, name):
    sql = contract.oracle_sql()[name]
    df = contract.queries()[name](spark, SF)
    got = df.collect()
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: SAME.get(t, t) for c, t in df.dtypes} == types
    assert len(got) == len(expected) > 0
    assert normalized(got, df.columns) == normalized(expected, columns)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
