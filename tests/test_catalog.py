"""Every catalogue query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SLOW = {"stream_session_summary", "stream_last_price", "stream_cursor", "ingest_events",
        "stream_event_counts", "rebuild_gold", "recover_event_counts", "rebuild_vanished_day",
        "backfill_ingest", "fetched_files"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    return str(v)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ticker", "trade_date", "open", "high", "low", "close", "quantity",
                          "financial_volume", "trades"]


def test_every_query_has_an_oracle():
    assert set(entry_mod.QUERIES) == set(entry_mod.ORACLE) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(n for n in entry_mod.oracle_sql() if n not in SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    rows = df.collect()
    cur = duck.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in rows)
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want
