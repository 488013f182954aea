"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.oracle import SQL
from tidemark.plans.queries import QUERIES
from tidemark.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return "∅" if v is None else str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["status", "count"] and df.count() >= 0


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(srows, df.columns) == _rows(drows, dcols)


def test_table_lists_files_anew(spark, tmp_dir):
    from tidemark.sources.tables import table
    spark.range(5).write.parquet(f"{tmp_dir}/region.parquet")
    assert table(spark, tmp_dir, "region").count() == 5
    spark.range(5).write.mode("append").parquet(f"{tmp_dir}/region.parquet")
    assert table(spark, tmp_dir, "region").count() == 10
