"""Every registered query that has SQL, against DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("COLSCOPE_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    want = duck.sql(entry.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(df.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    rows = duck.sql(f"SELECT {quoted} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, rows))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
