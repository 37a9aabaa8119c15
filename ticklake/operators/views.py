"""The trade views: event counts, deduplicated trades, last price, session OHLCV.

All are pure DataFrame -> DataFrame functions; batch jobs and the streaming serve job
call the same code. Every aggregate is algebraic (max/min/sum/count/min_by/max_by), so
Spark computes a partial aggregate before each shuffle: a hot ticker-day contributes one
partial row per map task, not all of its trades, to the reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.money import exact_price
from ticklake.schemas import ACTION_CANCELLED, SESSION_REGULAR, VOLUME

SESSION_KEYS = ["ticker", "trade_date"]
TRADE_KEYS = ["ticker", "trade_date", "trade_id"]


_EPOCH = "1970-01-01 00:00:00"
_NULL_TIME = 4 * 10**17      # above every shifted instant of years 0001-9999
_TIME_SHIFT = 10**17         # makes shifted micros of years 0001-9999 non-negative
_ID_SHIFT = 2**63            # makes every bigint trade id non-negative, < 10**20


def trade_order(traded_at: Column, trade_id: Column) -> Column:
    """Ascending trade order (traded_at NULLS LAST, trade_id) encoded as one DECIMAL(38,0).

    key = m * 10^20 + (trade_id + 2^63), with m = micros since epoch + 10^17, or 4*10^17
    for an unknown time (so it sorts after every known time, as the source SQL's ascending
    order does). Both parts are non-negative and the id part is < 10^20, so numeric order
    equals the lexicographic order, and the largest key is < 10^38. A decimal key keeps
    min_by/max_by in a HashAggregate (a struct key forces a sort-based aggregate).
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), traded_at)
    m = F.when(traded_at.isNull(), F.lit(_NULL_TIME)).otherwise(micros + F.lit(_TIME_SHIFT))
    big = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    return m.cast("decimal(38,0)") * big(10**20) + (trade_id.cast("decimal(38,0)") + big(_ID_SHIFT))


def session_event_counts(events: DataFrame) -> DataFrame:
    """A1: raw events per (ticker, trade_date): no NULL guard, re-deliveries counted."""
    return events.groupBy(*SESSION_KEYS).agg(F.count(F.lit(1)).alias("events"))


def trades_clean(events: DataFrame) -> DataFrame:
    """A2: one row per (ticker, trade_date, trade_id).

    Re-deliveries collapse with ``max`` per column; a cancellation anywhere in the group
    wins (``max(action) = 2``, so all-NULL actions give NULL and the row is dropped by
    every later ``NOT cancelled`` filter). Price text is cast leniently: bad text is NULL.
    """
    return (events
            .filter(F.col("ticker").isNotNull() & F.col("trade_date").isNotNull()
                    & F.col("trade_id").isNotNull())
            .groupBy(*TRADE_KEYS)
            .agg(F.max(exact_price(F.col("price"))).alias("price"),
                 F.max("quantity").alias("quantity"),
                 F.max("session_type").alias("session_type"),
                 F.max("traded_at").alias("traded_at"),
                 (F.max("action") == ACTION_CANCELLED).alias("cancelled")))


def live_trades(clean: DataFrame) -> DataFrame:
    """Non-cancelled trades (three-valued: a NULL flag is excluded too)."""
    return clean.filter(~F.col("cancelled"))


def session_aggregates() -> list[Column]:
    """A4-A7 aggregate columns over live trades of one (ticker, trade_date)."""
    regular = F.col("session_type") == SESSION_REGULAR
    order = trade_order(F.col("traded_at"), F.col("trade_id"))
    regular_order = F.when(regular, order)  # NULL order key = row skipped by min_by/max_by
    return [
        F.min_by("price", regular_order).alias("open"),
        F.max(F.when(regular, F.col("price"))).alias("high"),
        F.min(F.when(regular, F.col("price"))).alias("low"),
        F.max_by("price", regular_order).alias("close"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.sum(F.col("price") * F.col("quantity")).cast(VOLUME).alias("financial_volume"),
        F.count(F.lit(1)).alias("trades"),
    ]


def session_summary(clean: DataFrame) -> DataFrame:
    """A4: per-session OHLC over regular trades, totals over every session type."""
    return live_trades(clean).groupBy(*SESSION_KEYS).agg(*session_aggregates())


def session_last(live: DataFrame) -> DataFrame:
    """Latest live trade per (ticker, trade_date) and its order key.

    "Latest" is the source's ``ORDER BY traded_at DESC NULLS FIRST, trade_id DESC``: the
    maximum of ``trade_order`` (an unknown time counts as the latest).
    """
    key = trade_order(F.col("traded_at"), F.col("trade_id"))
    # Two scalar arg-maxes over the same key (unique within a session: it ends in the
    # trade id) pick the same row and keep the aggregate hash-based; an arg-max of a
    # struct would need a sort-based aggregate.
    return (live.groupBy(*SESSION_KEYS)
            .agg(F.max_by("price", key).alias("price"),
                 F.max_by("traded_at", key).alias("traded_at"),
                 F.max(key).alias("latest_key")))


def last_price_from_sessions(sessions_last: DataFrame) -> DataFrame:
    """A3 from per-session latest rows; a tie between sessions goes to the later session."""
    order = F.struct("latest_key", "trade_date")
    return (sessions_last.groupBy("ticker")
            .agg(F.max_by(F.struct("price", "traded_at"), order).alias("_p"))
            .select("ticker", F.col("_p.price").alias("price"),
                    F.col("_p.traded_at").alias("traded_at")))


def last_price(clean: DataFrame) -> DataFrame:
    """The latest live trade per ticker.

    Not ``row_number() OVER (PARTITION BY ticker ...)``: that window sorts every trade of
    a ticker in one task. Instead an arg-max per (ticker, session) - hash-aggregated and
    combined map-side, so a hot ticker costs one partial row per task - then an arg-max
    per ticker over those few rows.
    """
    return last_price_from_sessions(session_last(live_trades(clean)))


SUMMARY_COLUMNS = ["ticker", "trade_date", "open", "high", "low", "close", "quantity",
                   "financial_volume", "trades"]


def session_rollup(clean: DataFrame) -> DataFrame:
    """One aggregation per (ticker, trade_date) giving both the session summary (A4) and
    the session's latest live trade (input of A3). Serving reads that need both derive
    them from this one pass instead of deduplicating the trades twice."""
    key = trade_order(F.col("traded_at"), F.col("trade_id"))
    return (live_trades(clean).groupBy(*SESSION_KEYS)
            .agg(*session_aggregates(),
                 F.max_by("price", key).alias("last_trade_price"),
                 F.max_by("traded_at", key).alias("last_trade_at"),
                 F.max(key).alias("latest_key")))


def summary_of(rollup: DataFrame) -> DataFrame:
    return rollup.select(*SUMMARY_COLUMNS)


def last_price_of(rollup: DataFrame) -> DataFrame:
    return last_price_from_sessions(rollup.select(
        *SESSION_KEYS, F.col("last_trade_price").alias("price"),
        F.col("last_trade_at").alias("traded_at"), "latest_key"))


def latest_session(summary: DataFrame) -> DataFrame:
    """O2: most recent session row per ticker (arg-max of trade_date, no window)."""
    cols = [c for c in summary.columns if c != "ticker"]
    return (summary.groupBy("ticker")
            .agg(F.max_by(F.struct(*cols), F.col("trade_date")).alias("_s"))
            .select("ticker", *[F.col(f"_s.{c}").alias(c) for c in cols]))
