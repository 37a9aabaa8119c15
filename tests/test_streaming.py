"""Serve job: retractions across micro-batches, rebuild-from-bronze equality, replays."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from ticklake.operators import views
from ticklake.session import shared_dir
from ticklake.sources.tables import gold
from ticklake.sinks import pointer
from ticklake.streaming import counts, serve
from ticklake.streaming.replay import run_counts_over_drops, run_serve_over_drops

SCHEMA = ("schema_version int, ticker string, trade_id long, action int, price string, "
          "quantity long, traded_at timestamp_ntz, trade_date date, reference_date date, "
          "session_type int, source string, drop int")
D = dt.date(2026, 7, 21)


def ev(drop, ticker, tid, action, price, h, st=1, d=D):
    return (1, ticker, tid, action, price, 10, dt.datetime(d.year, d.month, d.day, h, 0), d, d,
            st, "intraday_poll", drop)


def _run(spark, rows):
    events = spark.createDataFrame(rows, SCHEMA)
    n = max(r[-1] for r in rows) + 1
    run_dir = shared_dir(spark, f"serve-test-{uuid.uuid4().hex[:8]}")
    return events, run_serve_over_drops(spark, events, F.col("drop"), n, run_dir)


def test_late_cancellations_retract_gold(spark):
    rows = [ev(0, "PETR4", 1, 0, "41.000", 13), ev(0, "PETR4", 2, 0, "42.000", 14),
            ev(0, "VALE3", 1, 0, "60.000", 13),
            ev(1, "PETR4", 2, 2, "42.000", 14),            # lowers high, moves close
            ev(2, "VALE3", 1, 2, "60.000", 13)]            # removes VALE3's only trade
    events, paths = _run(spark, rows)
    summary = {r.ticker: r for r in gold(spark, paths.summary).collect()}
    assert set(summary) == {"PETR4"}
    assert summary["PETR4"].high == Decimal("41.000") and summary["PETR4"].close == Decimal("41.000")
    lp = {r.ticker: r.price for r in gold(spark, paths.last_price).collect()}
    assert lp == {"PETR4": Decimal("41.000")}
    # marker rows keep the emptied key visible to the writer, invisible to readers
    raw = gold(spark, paths.summary, live_only=False).filter("is_marker").collect()
    assert [r.ticker for r in raw] == ["VALE3"]


def test_stream_equals_rebuild_from_bronze(spark):
    rows = [ev(k % 3, "PETR4" if k % 2 else "ITUB4", k % 7, 2 if k % 5 == 0 else 0,
               f"{40 + k % 9}.{k % 10}00", 10 + k % 8, st=6 if k % 4 == 0 else 1,
               d=D + dt.timedelta(days=k % 2)) for k in range(60)]
    events, paths = _run(spark, rows)
    streamed = gold(spark, paths.summary).select(
        "ticker", "trade_date", "open", "high", "low", "close", "quantity", "financial_volume", "trades")
    bronze = spark.read.parquet(paths.bronze)
    rebuilt = views.session_summary(views.trades_clean(bronze))
    batch = views.session_summary(views.trades_clean(events.drop("drop")))
    assert streamed.exceptAll(rebuilt).count() == 0 and rebuilt.exceptAll(streamed).count() == 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_bronze_replay_is_idempotent(spark):
    from ticklake.streaming import serve
    rows = [ev(0, "PETR4", 1, 0, "41.000", 13)]
    events, paths = _run(spark, rows)
    serve.process_batch(paths, events.drop("drop"), 0)   # the same batch delivered again
    assert spark.read.parquet(paths.bronze).count() == 1
    assert os.path.isdir(paths.checkpoint.removeprefix("file:"))


def test_untouched_keys_of_a_touched_day_are_carried_over(spark):
    rows = [ev(0, "PETR4", 1, 0, "41.000", 13), ev(0, "VALE3", 1, 0, "60.000", 13),
            ev(1, "PETR4", 2, 0, "42.000", 14)]            # drop 1 touches PETR4 only
    events, paths = _run(spark, rows)
    summary = {r.ticker: r.trades for r in gold(spark, paths.summary).collect()}
    assert summary == {"PETR4": 2, "VALE3": 1}
    bronze = spark.read.parquet(paths.bronze)
    assert bronze.count() == 3


def test_streaming_event_counts_include_null_keys_and_redeliveries(spark):
    from ticklake.streaming.replay import run_counts_over_drops
    rows = [ev(0, "PETR4", 1, 0, "41.000", 13), ev(0, "PETR4", 1, 0, "41.000", 13),
            ev(1, "PETR4", 2, 0, "42.000", 14), ev(1, None, 3, 0, "1.000", 14),
            ev(1, "VALE3", 1, 0, "60.000", 13)]
    events = spark.createDataFrame(rows, SCHEMA)
    out = run_counts_over_drops(spark, events, F.col("drop"), 2,
                                shared_dir(spark, f"counts-{uuid.uuid4().hex[:8]}"))
    got = {(r.ticker, r.trade_date): r.events for r in gold(spark, out).collect()}
    assert got == {("PETR4", D): 3, (None, D): 1, ("VALE3", D): 1}


def test_latest_trade_without_time_goes_to_violations(spark):
    rows = [ev(0, "PETR4", 1, 0, "41.000", 13), ev(0, "VALE3", 1, 0, "60.000", 13)]
    rows.append((1, "VALE3", 2, 0, "61.000", 10, None, D, D, 1, "intraday_poll", 0))
    events, paths = _run(spark, rows)
    lp = {r.ticker: r.price for r in gold(spark, paths.last_price).collect()}
    assert lp == {"PETR4": Decimal("41.000"), "VALE3": Decimal("60.000")}  # the newest complete trade
    [v] = spark.read.parquet(paths.violations).collect()
    assert (v.ticker, v.price, v.traded_at) == ("VALE3", Decimal("61.000"), None)


def test_replayed_batch_leaves_gold_unchanged(spark):
    from ticklake.streaming import serve
    rows = [ev(0, "PETR4", 1, 0, "41.000", 13), ev(0, "PETR4", 2, 0, "42.000", 14),
            ev(1, "PETR4", 2, 2, "42.000", 14), ev(1, "VALE3", 1, 0, "60.000", 13)]
    events, paths = _run(spark, rows)
    cols = ["ticker", "trade_date", "open", "high", "low", "close", "quantity", "financial_volume", "trades"]
    before = sorted(gold(spark, paths.summary).select(*cols).collect())
    lp_before = sorted(gold(spark, paths.last_price).collect())
    # the second drop is delivered again under the same batch id (failure after its writes)
    serve.process_batch(paths, events.filter("drop = 1").drop("drop"), 1)
    assert sorted(gold(spark, paths.summary).select(*cols).collect()) == before
    assert sorted(gold(spark, paths.last_price).collect()) == lp_before
    assert spark.read.parquet(paths.bronze).count() == 4


SUMMARY = ["ticker", "trade_date", "open", "high", "low", "close", "quantity", "financial_volume", "trades"]


def _gold(spark, paths):
    return [sorted(map(str, gold(spark, p).select(*c).collect())) for p, c in (
        (paths.summary, SUMMARY), (paths.last_price, ["ticker", "price", "traded_at"]),
        (paths.violations, ["ticker", "trade_date", "price", "traded_at"]))]


def _serve(spark, batches, slots=8):
    paths = serve.ServePaths(shared_dir(spark, f"serve-{uuid.uuid4().hex[:8]}"))
    figures = [serve.process_batch(paths, spark.createDataFrame([r[:-1] for r in rows], SCHEMA.rpartition(",")[0]), k, slots)
               for k, rows in enumerate(batches)]
    return paths, figures


def _many(n, seed=0):
    """Trades of one day of a few tickers, some without a time, with cancellations."""
    rows = [ev(0, f"TK{k % 5}", k // 2, 2 if k % 7 == seed % 7 else 0, f"{40 + (k * 37 + seed) % 11}.000", 10 + k % 8) for k in range(n)]
    return [r if k % 13 else (*r[:6], None, *r[7:]) for k, r in enumerate(rows)]


def test_a_batch_reads_its_own_slots(spark):
    paths, figures = _serve(spark, [_many(2000), [ev(0, "TK1", 3, 2, "1.000", 9)], _many(6, 1)], slots=64)
    assert figures[0]["read"] == figures[0]["trades"] > 900
    assert figures[1]["trades"] == 1 and figures[1]["read"] < 2 * 1000 / 64 + 20  # a slot of the day
    assert figures[2]["trades"] <= 6 and figures[2]["read"] < 6 * (1000 / 64 + 20)


def test_batches_equal_the_views_over_all_events(spark):
    batches = [_many(300), _many(40, 3), [ev(0, "TK2", 4, 2, "99.000", 9, d=D + dt.timedelta(1))], _many(25, 5)]
    paths, _ = _serve(spark, batches)
    events = spark.createDataFrame([r[:-1] for rows in batches for r in rows], SCHEMA.rpartition(",")[0])
    want = sorted(map(str, views.session_summary(views.trades_clean(events)).select(*SUMMARY).collect()))
    assert _gold(spark, paths)[0] == want
    state = _gold(spark, paths)
    serve.compact(spark, paths, 2)  # batch 3 stays as a delta
    assert {r[0] for r in spark.read.parquet(paths.trades).select("batch_id").distinct().collect()} == {-3, 3}
    for k in (3, 0):  # a batch again, also one that is folded
        serve.process_batch(paths, spark.createDataFrame([r[:-1] for r in batches[k]], SCHEMA.rpartition(",")[0]), k, 8)
        assert _gold(spark, paths) == state
    serve.compact(spark, paths, 3)
    more = [ev(0, "TK0", 900, 0, "77.000", 17)]
    serve.process_batch(paths, spark.createDataFrame([r[:-1] for r in more], SCHEMA.rpartition(",")[0]), 4, 8)
    events = events.union(spark.createDataFrame([r[:-1] for r in more], SCHEMA.rpartition(",")[0]))
    assert _gold(spark, paths)[0] == sorted(map(str, views.session_summary(views.trades_clean(events)).select(*SUMMARY).collect()))


def test_rebuild_after_a_day_vanished(spark):
    day = D + dt.timedelta(1)
    batches = [[ev(0, "A", 1, 0, "41.000", 13), (1, "A", 2, 0, "42.000", 5, None, D, D, 1, "x", 0)],
               [ev(0, "B", 1, 0, "50.000", 13, d=day), (1, "B", 2, 0, "51.000", 5, None, day, day, 1, "x", 0)],
               [ev(0, "C", 1, 0, "60.000", 13)]]
    paths, _ = _serve(spark, batches)
    listed = [(r.ticker, r.trade_date) for r in gold(spark, paths.violations).collect()]
    assert sorted(listed) == [("A", D), ("B", day)]  # once each, though batch 2 touched A's day again
    first = serve.rebuild(spark, paths)
    assert _gold(spark, first) == _gold(spark, paths)
    pointer.delete(spark, f"{paths.bronze}/trade_date={day}")
    now = serve.rebuild(spark, first)
    assert serve.current(spark, paths.base) == now
    assert {r.ticker for r in gold(spark, now.summary).collect()} == {"A", "C"}
    assert {r.ticker for r in gold(spark, now.last_price).collect()} == {"A", "C"}
    assert [(r.ticker, r.trade_date) for r in gold(spark, now.violations).collect()] == [("A", D)]
    assert len(_gold(spark, first)[0]) == 3  # readers of the old folder still read it whole
    serve.process_batch(now, spark.createDataFrame([r[:-1] for r in batches[1]], SCHEMA.rpartition(",")[0]), 3, 8)
    assert _gold(spark, now) == _gold(spark, first)


def test_counts_heal_from_the_state(spark):
    days = [D + dt.timedelta(k) for k in range(4)]
    rows = [ev(k % 2, ["PETR4", "VALE3", None][k % 3], k, 0, "1.000", 13, d=days[k % 4]) for k in range(40)]
    run_dir = shared_dir(spark, f"counts-{uuid.uuid4().hex[:8]}")
    out = run_counts_over_drops(spark, spark.createDataFrame(rows, SCHEMA), F.col("drop"), 2, run_dir)
    checkpoint = f"{run_dir}/_checkpoints/counts"

    def held():
        return sorted(map(str, gold(spark, out).select("ticker", "trade_date", "events").collect()))

    right = held()
    assert counts.heal(spark, out, checkpoint).count() == 0 and held() == right
    pointer.delete(spark, f"{out}/trade_date={days[1]}")
    wrong = gold(spark, out).where(F.col("trade_date") == days[2]).withColumns({"events": F.col("events") + 1, "is_marker": F.lit(False)})
    stray = spark.createDataFrame([("XX", days[0] - dt.timedelta(9), 3, False)], "ticker string, trade_date date, events long, is_marker boolean")
    from ticklake.sinks.keyed import replace_partitions
    replace_partitions(wrong.unionByName(stray).checkpoint(), out, ["trade_date"])
    assert held() != right
    assert counts.heal(spark, out, checkpoint).count() == 3 and held() == right
    for folder in pointer.subfolders(spark, out):
        pointer.delete(spark, folder)
    assert counts.heal(spark, out, checkpoint).count() == 4 and held() == right


def test_a_batch_without_trades(spark):
    paths, figures = _serve(spark, [[], [ev(0, None, 1, 0, "1.000", 13)], [ev(0, "A", 1, 0, "41.000", 13)]])
    assert [f["trades"] for f in figures] == [0, 0, 1]
    assert [r.ticker for r in gold(spark, paths.summary).collect()] == ["A"]
