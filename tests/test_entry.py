import duckdb
import pytest

import __spark_entry__ as entry
from cairn.plans.oracle import ORACLE
from cairn.plans.queries import QUERIES
from frames import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"o_custkey", "c_mktsegment", "total", "rank"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows):
    return sorted(repr(tuple(None if v != v else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_on_small_tables(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(ORACLE[name])
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)
    s_rows = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    idx = [o_cols.index(c) for c in sorted(o_cols)]
    o_rows = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert _norm(s_rows) == _norm(o_rows)
