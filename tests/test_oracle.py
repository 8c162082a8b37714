"""Every registered query against its SQL on the smallest driver tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem documents pages embeddings conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return format(v.normalize(), "f") if v else "0"
    if isinstance(v, float):
        return f"{v:.9g}"
    return None if v is None else str(v)


def as_rows(columns, rows, order):
    at = [columns.index(c) for c in order]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    order = sorted(df.columns)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == order
    expected = as_rows(columns, cursor.fetchall(), order)
    assert expected, "the check needs rows"
    assert as_rows(df.columns, [tuple(r) for r in df.collect()], order) == expected


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["line_id", "prd_id", "amount"]
