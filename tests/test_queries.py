"""Every registered query against its SQL in DuckDB on the same files."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = entry_points.queries()[name](spark, FOLDER)
    collected = [tuple(r) for r in result.collect()]
    sql = ORACLE[name]
    expected = duck.execute(sql)
    names = [c[0] for c in expected.description]
    wanted = expected.fetchall()
    assert sorted(result.columns) == sorted(names)
    assert len(collected) == len(wanted)
    assert normal(result.columns, collected) == normal(names, wanted)
    assert wanted, "an empty result checks nothing"


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
