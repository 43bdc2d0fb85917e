"""Every registered query against its DuckDB oracle (row count, columns, order-insensitive values)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL
from tools.check_oracle import TABLES, digest

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, key):
    assert QUERIES[key](spark, SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"level", "area_id", "area_name", "series", "x", "x_ord", "y"}
