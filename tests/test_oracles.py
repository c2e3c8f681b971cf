"""Every query with oracle SQL against DuckDB, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in SF.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def norm(v):
    return round(v, 9) if isinstance(v, float) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in rows], key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, duck, name):
    df = entry.queries()[name](spark, str(SF))
    told = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in told.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, told.fetchall())
