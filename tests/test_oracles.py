"""Every query against DuckDB's rows over the same tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from paperloom.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
WITH_SQL = [k for k in registry.queries() if k in registry.oracle_sql()]


def plain(value):
    if hasattr(value, "as_tuple"):
        value = float(value)
    return float(f"{value:.9g}") if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", WITH_SQL)
def test_rows_match(spark, data, duck, name):
    df = registry.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
    want = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in order) for r in want.fetchall())


def test_every_query_has_sql():
    assert set(registry.queries()) == set(WITH_SQL)


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
