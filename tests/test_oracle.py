"""Every query with SQL is compared with DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from colonnade.tables import SCHEMAS


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return None if v is None else str(v).replace(" 00:00:00", "")


def _rows(rows, order):
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple("" if v is None else v for v in r))


@pytest.fixture(scope="session")
def con(sf_dir):
    c = duckdb.connect()
    for t in SCHEMAS:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = _rows(cur.fetchall(), [cols.index(c) for c in sorted(cols)])
    got = _rows([tuple(r) for r in df.select(*[f"`{c}`" for c in sorted(cols)]).collect()], range(len(cols)))
    assert got == want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).limit(1).count() == 1


def test_entry(spark):
    assert entry.entry(spark).count() > 0
