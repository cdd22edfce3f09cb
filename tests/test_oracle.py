"""Every catalogue query at sf0.01 against its DuckDB SQL oracle:
same column names, same row multiset."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import canon
from conftest import SF001
from eventide.sources.tables import TABLES

LLM = E._llm()[0]      # tested in tests/llm
QUERIES = {k: v for k, v in E.queries().items() if k not in LLM}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(srows, df.columns) == canon(res.fetchall(), dcols)


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.count() > 0
    assert out.columns == ["window_start", "window_end", "event_type", "sum_value", "n", "last_ts"]
