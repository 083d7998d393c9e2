"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def ordered(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry_points.QUERIES))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = ordered([tuple(r[c] for c in columns) for r in df.collect()])
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == ordered([tuple(r[i] for i in order) for r in cursor.fetchall()])


def test_entry(spark):
    assert entry_points.entry(spark).count() == 21


def test_queries_without_sql():
    missing = set(entry_points.QUERIES) - set(entry_points.SQL)
    assert missing == {"rougel_pairs", "rouge_stemmed", "rouge_report", "model_benchmark_full"}
