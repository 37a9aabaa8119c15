"""The health report over a grid of clocks and ages; the market window minute by minute."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticklake.functions.timefmt import market_window_open, utc_literal
from ticklake.operators import audit, serving

IN_HOURS = dt.datetime(2025, 9, 10, 15, 30)   # a Wednesday, half past noon in Sao Paulo
AT_NIGHT = dt.datetime(2025, 9, 11, 4, 0)
MINUTE, HOUR = dt.timedelta(minutes=1), dt.timedelta(hours=1)


def report(spark, now, trade_age, sync_age, days=1):
    trades = [] if trade_age is None else [("WEGE3", now - trade_age), ("RADL3", now - trade_age - 9 * HOUR)]
    syncs = [] if sync_age is None else [(now - sync_age,), (now - sync_age - HOUR,)]
    sessions = [(now.date() - dt.timedelta(days=k),) for k in range(days)]
    return serving.health(
        spark, spark.createDataFrame(trades, "ticker string, traded_at timestamp_ntz"),
        spark.createDataFrame(syncs, "synced_at timestamp_ntz"),
        spark.createDataFrame(sessions, "trade_date date"), now).first()


@pytest.mark.parametrize("now, trade_age, sync_age, status", [
    (IN_HOURS, 29 * MINUTE, 6 * HOUR, "ok"),
    (IN_HOURS, 31 * MINUTE, 6 * HOUR, "degraded"),
    (IN_HOURS, 29 * MINUTE, 8 * HOUR, "degraded"),
    (AT_NIGHT, 12 * HOUR, 6 * HOUR, "ok"),           # nothing trades at night
    (AT_NIGHT, 12 * HOUR, 8 * HOUR, "degraded"),     # but actions are synced around the clock
    (IN_HOURS, None, 6 * HOUR, "degraded"),
    (IN_HOURS, 29 * MINUTE, None, "degraded"),
])
def test_status(spark, now, trade_age, sync_age, status):
    row = report(spark, now, trade_age, sync_age)
    assert row.status == status
    assert row.market_window_open == (now == IN_HOURS)
    if trade_age is not None:
        assert row.trades_age_seconds == trade_age.total_seconds()  # of the newest trade


def test_an_empty_store_still_reports(spark):
    row = report(spark, IN_HOURS, None, None, days=0)
    assert (row.status, row.trades_latest_traded_at, row.sessions_count) == ("degraded", None, 0)


def test_the_window_over_a_week(spark):
    """Open on weekdays from 09:55 to 18:35 Sao Paulo time, both included."""
    start = dt.datetime(2025, 9, 8, 0, 0)
    clocks = [start + dt.timedelta(days=d, minutes=m) for d in range(7)
              for m in (0, 774, 775, 900, 1295, 1296, 1439)]
    got = spark.range(1).select(*[market_window_open(utc_literal(c)).alias(f"c{k}") for k, c in enumerate(clocks)]).first()
    for k, c in enumerate(clocks):
        local = c - 3 * HOUR
        minute = local.hour * 60 + local.minute
        assert got[k] == (local.weekday() < 5 and 595 <= minute <= 1115), c


def test_the_window_does_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Pacific/Auckland", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.range(1).select(market_window_open(utc_literal(IN_HOURS)), market_window_open(utc_literal(AT_NIGHT)))
            assert tuple(row.first()) == (True, False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar_is_sorted_and_has_weekdays_only(spark):
    runs = spark.createDataFrame([(dt.date(2025, 9, 15),), (dt.date(2025, 9, 10),)], "run_date date")
    rows = [(r.run_date, r.session_date) for r in audit.trading_calendar(runs, days=9).collect()]
    assert rows == sorted(rows)
    for run, day in rows:
        assert day.weekday() < 5 and 0 < (run - day).days <= 9
    assert sum(run == dt.date(2025, 9, 15) for run, _ in rows) == 5
    assert runs.select(F.count("*")).first()[0] == 2
