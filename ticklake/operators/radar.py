"""Dividend radar and price-position figures, computed as DataFrame aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.text import short_label
from ticklake.functions.timefmt import age_seconds, utc_literal
from ticklake.operators import dividends as dv

SUM_GROSS = "decimal(38,11)"
SUM_NET = "decimal(38,13)"


def radar(cash: DataFrame, last_price: DataFrame, as_of) -> DataFrame:
    """A11 + O4 + F23: per ticker with pending dividends: event count, gross and net sums
    (exact decimals), total yield on the last price, next dated payment (undated ones are
    skipped by ``min``), and the relative bar width against the best yield.

    The best yield is a scalar subquery over the aggregated rows (no global window).
    """
    rows = dv.pending_numeric(cash, last_price, as_of)
    per = rows.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("rate").cast(SUM_GROSS).alias("gross"),
        F.sum("net").cast(SUM_NET).alias("net"),
        F.first("price").alias("price"),          # one price per ticker
        F.min("payment_date").alias("next_payment"),
        F.count_if(F.col("label") == "JRS CAP PROPRIO").alias("jcp_events"),
    )
    total_yield = F.try_divide(F.col("gross").cast("double"), F.col("price").cast("double"))
    per = per.withColumn("total_yield", total_yield)
    best = per.select(F.greatest(F.max("total_yield"), F.lit(1e-9))).scalar()
    return (per.withColumn("bar_width", F.greatest(F.lit(2.0), F.lit(100.0) * F.col("total_yield") / best))
               .orderBy(F.desc("total_yield"), "ticker"))


def headline(radar_rows: DataFrame, cash: DataFrame, last_price: DataFrame, as_of) -> DataFrame:
    """Pending events, tickers with pending events, best ticker / yield / its event
    count, undated events, and the age of the newest trade behind the prices."""
    today = dv.market_today(as_of)
    undated = (cash.filter(dv.is_pending(F.col("payment_date"), today)
                           & F.col("payment_date").isNull())
               .join(last_price.select("ticker"), "ticker", "left_semi")
               .select(F.count(F.lit(1))).scalar())
    newest = last_price.select(F.max("traded_at")).scalar()
    best = F.min_by(F.struct("ticker", "total_yield", "events"),
                    F.struct((-F.col("total_yield")).alias("y"), F.col("ticker")))
    return radar_rows.agg(
        F.sum("events").cast("bigint").alias("pending_events"),
        F.count(F.lit(1)).alias("tickers"),
        best.alias("_best"),
    ).select(
        "pending_events", "tickers",
        F.col("_best.ticker").alias("best_ticker"),
        F.col("_best.total_yield").alias("best_yield"),
        F.col("_best.events").alias("best_events"),
        undated.alias("undated_events"),
        age_seconds(utc_literal(as_of), newest).alias("newest_trade_age_seconds"),
    )


def event_rows(cash: DataFrame, last_price: DataFrame, as_of) -> DataFrame:
    """Radar detail rows: short type label (P14), payment order with undated last."""
    rows = dv.pending(cash, last_price, as_of, ordered=False)
    return rows.select("ticker", short_label(F.col("type")).alias("type_short"), "status",
                       "payment_date", "payment_tbd", "yield_on_last_price") \
               .orderBy("ticker", F.asc_nulls_last("payment_date"))


def day_change(latest_sessions: DataFrame) -> DataFrame:
    """(close - open) / open and its direction, for sessions with both prices."""
    o = F.col("open").cast("double")
    c = F.col("close").cast("double")
    chg = F.try_divide(c - o, o)  # NULL where the open is 0
    return (latest_sessions.filter(F.col("open").isNotNull() & F.col("close").isNotNull())
            .select("ticker", "trade_date", chg.alias("day_change"),
                    F.when(chg >= 0, F.lit("up")).when(chg < 0, F.lit("down")).alias("direction")))


def range_position(latest_sessions: DataFrame, last_price: DataFrame) -> DataFrame:
    """where the open and the last price sit in the day's low-high range, 0-100
    (a zero-width range counts as width 1), for sessions with both low and high."""
    lo = F.col("low").cast("double")
    hi = F.col("high").cast("double")
    span = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)

    def at(v):
        return F.lit(100.0) * (v.cast("double") - lo) / span

    s = latest_sessions.filter(F.col("low").isNotNull() & F.col("high").isNotNull())
    return (s.join(last_price.select("ticker", F.col("price").alias("last")), "ticker")
             .select("ticker", "trade_date", at(F.col("open")).alias("open_position"),
                     at(F.col("last")).alias("last_position")))
