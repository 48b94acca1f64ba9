"""The operators that SQL can express, against it."""

import duckdb
import pytest

from eventmart.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in ORACLE if n.split("_")[0] in ("op11", "op12", "op13")])
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    wanted = duck.execute(ORACLE[name])
    names = sorted(c[0] for c in wanted.description)
    order = [[c[0] for c in wanted.description].index(n) for n in names]
    rows = [tuple(r[i] for i in order) for r in wanted.fetchall()]
    result = QUERIES[name](spark, FOLDER)
    assert sorted(result.columns) == names and rows
    assert sorted(map(str, map(tuple, result.select(names).collect()))) == sorted(map(str, rows))
