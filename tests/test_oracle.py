"""Every query with SQL against DuckDB on the small tables."""

import glob
import os
from decimal import Decimal

import duckdb
import pytest

from evidentia import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, (float, Decimal)):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    frame = catalogue.queries()[name](spark, FOLDER)
    cols = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in frame.collect()), key=repr)
    result = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in result.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_other_queries_give_rows(spark, name):
    assert catalogue.queries()[name](spark, FOLDER).count() > 0


def test_the_whole_is_registered():
    import __spark_entry__ as entry

    assert set(catalogue.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_outside_imports_the_training_operators():
    import subprocess

    found = subprocess.run(["grep", "-rlE", r"evidentia\.llm|from \.llm", "evidentia", "bench.py"], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(__file__))).stdout.split()
    assert all(f.startswith("evidentia/llm/") for f in found if f.endswith(".py"))
