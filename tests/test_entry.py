"""Every query with SQL gives what DuckDB gives, at the smallest scale."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from heronry import queries as library

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def plain(df):
    columns = sorted(df.columns)
    return columns, sorted(df[columns].astype(str).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql())))
def test_same_as_sql(spark, duck, name):
    assert plain(entry.queries()[name](spark, SF).toPandas()) == plain(duck.sql(entry.oracle_sql()[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_library_stands_alone():
    """With a module that only the training operators need out of reach, the others stay registered."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'op3_simhash' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True).stdout.split()
    assert out == [str(len(library.QUERIES)), str(len(library.SQL)), "False"]
