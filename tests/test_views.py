"""Dedup/cancel view, last price and session OHLCV semantics (incl. NULL ordering traps)."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from ticklake.operators import views

SCHEMA = ("ticker string, trade_date date, trade_id long, action int, price string, "
          "quantity long, traded_at timestamp_ntz, session_type int")
D = dt.date(2026, 7, 21)


def t(h, m):
    return dt.datetime(2026, 7, 21, h, m)


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


BASE = [
    ("PETR4", D, 1, 0, "41.000", 100, t(13, 0), 1),
    ("PETR4", D, 2, 0, "41.500", 200, t(14, 0), 1),
    ("PETR4", D, 3, 0, "40.800", 300, t(15, 0), 1),
    ("PETR4", D, 4, 0, "41.250", 400, t(16, 0), 1),
    ("PETR4", D, 5, 0, "39.000", 50, t(21, 0), 6),   # after-market: totals only
]


def _summary(spark, rows):
    return {(r.ticker, r.trade_date): r for r in
            views.session_summary(views.trades_clean(_events(spark, rows))).collect()}


def test_ohlc_regular_only_totals_all_sessions(spark):
    r = _summary(spark, BASE)[("PETR4", D)]
    assert (r.open, r.high, r.low, r.close) == tuple(Decimal(x) for x in ("41.000", "41.500", "40.800", "41.250"))
    assert (r.quantity, r.trades) == (1050, 5)
    assert r.financial_volume == Decimal("41.000") * 100 + Decimal("41.500") * 200 + \
        Decimal("40.800") * 300 + Decimal("41.250") * 400 + Decimal("39.000") * 50


def test_redelivery_collapses_and_cancellation_wins(spark):
    rows = BASE + [BASE[1], ("PETR4", D, 2, 2, "41.500", 200, t(14, 0), 1)]
    r = _summary(spark, rows)[("PETR4", D)]
    assert r.high == Decimal("41.250") and r.trades == 4


def test_null_ohlc_with_totals(spark):
    r = _summary(spark, [BASE[4]])[("PETR4", D)]
    assert (r.open, r.high, r.low, r.close) == (None, None, None, None)
    assert (r.quantity, r.trades) == (50, 1)


def test_null_traded_at_sorts_last_for_open_and_close(spark):
    rows = BASE[:2] + [("PETR4", D, 9, 0, "50.000", 1, None, 1)]
    r = _summary(spark, rows)[("PETR4", D)]
    assert r.open == Decimal("41.000")   # the unknown time is never the first trade
    assert r.close == Decimal("50.000")  # ascending NULLS LAST: it is the last one


def test_action_above_two_uncancels_and_all_null_actions_drop(spark):
    rows = [("PETR4", D, 1, 2, "41.000", 1, t(13, 0), 1), ("PETR4", D, 1, 3, "41.000", 1, t(13, 0), 1),
            ("PETR4", D, 2, None, "42.000", 1, t(13, 1), 1)]
    clean = {r.trade_id: r.cancelled for r in views.trades_clean(_events(spark, rows)).collect()}
    assert clean == {1: False, 2: None}
    assert _summary(spark, rows)[("PETR4", D)].trades == 1


def test_null_keys_are_guarded_but_counted(spark):
    rows = BASE[:1] + [(None, D, 7, 0, "1.000", 1, t(13, 0), 1), ("PETR4", None, 8, 0, "1.000", 1, t(13, 0), 1)]
    ev = _events(spark, rows)
    assert views.trades_clean(ev).count() == 1
    assert views.session_event_counts(ev).groupBy().sum("events").first()[0] == 3


def test_bad_price_text_does_not_stop_the_view(spark):
    rows = [("PETR4", D, 1, 0, "abc", 1, t(13, 0), 1)]
    assert views.trades_clean(_events(spark, rows)).first().price is None


def test_last_price_latest_by_time_then_id(spark):
    rows = BASE + [("PETR4", D, 6, 0, "41.300", 1, t(21, 0), 6), ("VALE3", D, 1, 0, "60.000", 1, t(13, 0), 1)]
    lp = {r.ticker: (r.price, r.traded_at) for r in views.last_price(views.trades_clean(_events(spark, rows))).collect()}
    assert lp["PETR4"] == (Decimal("41.300"), t(21, 0))  # same time as id 5, higher id wins
    assert lp["VALE3"] == (Decimal("60.000"), t(13, 0))


def test_last_price_null_time_counts_as_latest(spark):
    rows = BASE[:2] + [("PETR4", D, 1, 0, "99.000", 1, None, 1)]
    rows = [BASE[1], ("PETR4", D, 9, 0, "99.000", 1, None, 1)]
    [r] = views.last_price(views.trades_clean(_events(spark, rows))).collect()
    assert r.price == Decimal("99.000") and r.traded_at is None


def test_cancelled_latest_trade_falls_back(spark):
    rows = BASE[:4] + [("PETR4", D, 4, 2, "41.250", 400, t(16, 0), 1)]
    [r] = views.last_price(views.trades_clean(_events(spark, rows))).collect()
    assert r.price == Decimal("40.800")


def test_latest_session_per_ticker(spark):
    d2 = dt.date(2026, 7, 22)
    rows = BASE + [("PETR4", d2, 1, 0, "42.000", 10, dt.datetime(2026, 7, 22, 13, 0), 1)]
    [r] = views.latest_session(views.session_summary(views.trades_clean(_events(spark, rows)))).collect()
    assert r.trade_date == d2 and r.trades == 1


@settings(max_examples=5, deadline=None)
@given(st.randoms(use_true_random=False))
def test_order_and_redelivery_independence(spark, rnd: random.Random):
    """T5: permuting and duplicating the events never changes the views."""
    rows = BASE + [("PETR4", D, 3, 2, "40.800", 300, t(15, 0), 1)]
    shuffled = rows + [rnd.choice(rows) for _ in range(4)]
    rnd.shuffle(shuffled)
    a = _summary(spark, rows)[("PETR4", D)]
    b = _summary(spark, shuffled)[("PETR4", D)]
    assert a == b
