"""The publish cursor against a small model of it, over random snapshots."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ticklake.functions.text import cursor_key
from ticklake.operators import cursor

DAYS = [dt.date(2025, 4, 1), dt.date(2025, 4, 2)]
TRADE = "ticker string, trade_date date, trade_id long, action int"
CURSOR = "ticker string, trade_date date, max_trade_id long"


def model(trades, before):
    """What is published, and the cursor afterwards."""
    out = [t for t in trades if t[3] == 2 or t[2] > before.get(t[:2], 0)]
    after = dict(before)
    for t in out:
        if t[3] != 2:
            after[t[:2]] = max(after.get(t[:2], 0), t[2])
    return out, after


@pytest.mark.parametrize("seed", range(3))
def test_random_snapshots_follow_the_model(spark, seed):
    rnd = random.Random(seed)
    keys = [(t, d) for t in ("EMBR3", "SUZB3", "RAIL3") for d in DAYS]
    before = {k: rnd.randrange(1, 40) for k in keys[:4]}
    trades = [(*rnd.choice(keys), rnd.randrange(1, 60), rnd.choice((0, 0, 1, 2))) for _ in range(120)]
    trades += trades[:10]  # the same trade twice in one snapshot
    df = spark.createDataFrame(trades, TRADE)
    old = spark.createDataFrame([(*k, v) for k, v in before.items()], CURSOR)
    published, after = model(trades, before)
    out = cursor.filter_new(df, old)
    assert sorted(map(tuple, out.collect())) == sorted(published)
    flagged = cursor.mark_new(df, old)
    assert flagged.count() == len(trades) and flagged.where("is_new").count() == len(published)
    moved = cursor.advance(old, cursor.updates(out))
    assert {(r.ticker, r.trade_date): r.max_trade_id for r in moved.collect()} == after
    # the same snapshot again publishes cancellations only
    again = cursor.filter_new(df, moved.select(cursor.KEYS + ["max_trade_id"]))
    assert {r.action for r in again.collect()} <= {2}


@pytest.mark.parametrize("rows, cursor_at, kept", [
    ([("KLBN11", DAYS[0], 5, 0)], None, 1),          # a session never seen
    ([("KLBN11", DAYS[0], 5, 0)], 5, 0),             # at the cursor
    ([("KLBN11", DAYS[0], 6, 0)], 5, 1),             # above it
    ([("KLBN11", DAYS[0], 1, 2)], 1000, 1),          # a cancellation, whatever its id
    ([("KLBN11", DAYS[1], 1, 0)], 1000, 1),          # another session of the ticker
    ([("KLBN11", DAYS[0], 4, 0)], 5, 0),             # late, below the cursor: never sent again
])
def test_single_decisions(spark, rows, cursor_at, kept):
    old = spark.createDataFrame([] if cursor_at is None else [("KLBN11", DAYS[0], cursor_at)], CURSOR)
    assert cursor.filter_new(spark.createDataFrame(rows, TRADE), old).count() == kept


def test_records_round_trip_through_the_log(spark):
    old = spark.createDataFrame([("TOTS3", DAYS[0], 12, 0), ("TOTS3", DAYS[1], 9, 0), ("VIVT3", DAYS[0], 3, 2)], TRADE)
    records = cursor.value_json(cursor.updates(old))
    assert records.columns == ["key", "value"]
    log = records.withColumn("partition", F.lit(0)).withColumn("offset", F.lit(1))
    gone = spark.createDataFrame([("TOTS3:2025-04-02", None)], "key string, value string").select(
        "key", "value", F.lit(0).alias("partition"), F.lit(2).alias("offset"))
    older = spark.createDataFrame([("TOTS3:2025-04-01", '{"max_trade_id": 2}')], "key string, value string").select(
        "key", "value", F.lit(0).alias("partition"), F.lit(0).alias("offset"))
    folded = cursor.fold_log(log.union(gone).union(older)).collect()
    assert [(r.key, r.max_trade_id) for r in folded] == [("TOTS3:2025-04-01", 12)]


def test_keys_name_ticker_and_session(spark):
    row = spark.createDataFrame([("RAIL3", DAYS[1])], "t string, d date").select(cursor_key(F.col("t"), F.col("d")))
    assert row.first()[0] == "RAIL3:2025-04-02"


def test_stream_cursor_parses_its_lines_once(spark, monkeypatch):
    from tests.conftest import SF_SMALL
    from ticklake.plans import catalog
    seen = []

    class Done(Exception):
        pass

    def take(spark, trades, *_):
        seen.append(trades._jdf.queryExecution().optimizedPlan().toString())
        raise Done

    monkeypatch.setattr(catalog, "run_cursor_over_drops", take)
    try:
        catalog.q_stream_cursor(spark, SF_SMALL)
    except Done:
        pass
    assert seen and "split(" not in seen[0]
