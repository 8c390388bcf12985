"""Every registered query of the engine against its DuckDB SQL."""

import datetime

import duckdb
import pytest

from spanlake import catalog

TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_matches_sql(spark, sf_dir, duck, name):
    cur = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    want = sorted([plain(v) for _, v in sorted(zip(names, row))] for row in cur.fetchall())
    df = catalog.queries()[name](spark, sf_dir)
    found = sorted([plain(r[c]) for c in sorted(names)] for r in df.collect())
    assert sorted(df.columns) == sorted(names)
    assert found == want


def test_entry(spark):
    import __spark_entry__ as e

    assert "usage_hour" in e.entry(spark).columns
    assert set(e.oracle_sql()) <= set(e.queries())
