"""Session views by parts, for incremental maintenance.

Trades are dealt into slots by a hash of their key. A part aggregates one session's trades of
one slot, with the order keys of what it picked; parts of a session combine to its summary,
its latest trade and its violation. All aggregates are algebraic and of fixed width, so a
changed trade costs its slot's trades of that session and then one row a slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.money import exact_price
from ticklake.operators.views import SESSION_KEYS, SUMMARY_COLUMNS, TRADE_KEYS, trade_order
from ticklake.schemas import ACTION_CANCELLED, SESSION_REGULAR, VOLUME

_MERGED = ["price", "quantity", "session_type", "traded_at", "action"]


def slot_of(slots: int) -> Column:
    return F.pmod(F.xxhash64(*TRADE_KEYS), F.lit(slots)).cast("int")


def merge_trades(versions: DataFrame, *extra: str) -> DataFrame:
    """One row per trade: the largest of each column over its versions (A2 by columns). Merging is
    idempotent and takes its own results, so deltas may overlap."""
    return versions.groupBy(*TRADE_KEYS, *extra).agg(*[F.max(c).alias(c) for c in _MERGED])


def trade_versions(events: DataFrame) -> DataFrame:
    """The typed, keyed trades of raw events, one row per trade."""
    known = events.where(" and ".join(f"{k} is not null" for k in TRADE_KEYS))
    return merge_trades(known.select(*TRADE_KEYS, exact_price(F.col("price")).alias("price"), *_MERGED[1:]))


def session_parts(trades: DataFrame) -> DataFrame:
    """One row per (ticker, trade_date, slot) of merged trades, also where none is live."""
    live = F.coalesce(F.col("action") != ACTION_CANCELLED, F.lit(False))
    regular = live & (F.col("session_type") == SESSION_REGULAR)
    key = trade_order(F.col("traded_at"), F.col("trade_id"))
    complete = F.when(live & F.col("price").isNotNull() & F.col("traded_at").isNotNull(), key)
    return trades.groupBy(*SESSION_KEYS, "slot").agg(
        F.min(F.when(regular, key)).alias("open_key"), F.min_by("price", F.when(regular, key)).alias("open"),
        F.max(F.when(regular, F.col("price"))).alias("high"), F.min(F.when(regular, F.col("price"))).alias("low"),
        F.max(F.when(regular, key)).alias("close_key"), F.max_by("price", F.when(regular, key)).alias("close"),
        F.sum(F.when(live, F.col("quantity"))).cast("bigint").alias("quantity"),
        F.sum(F.when(live, F.col("price") * F.col("quantity"))).cast(VOLUME).alias("financial_volume"),
        F.count_if(live).alias("trades"),
        F.max(complete).alias("last_key"), F.max_by("price", complete).alias("last_price"),
        F.max_by("traded_at", complete).alias("last_at"),
        F.max(F.when(live, key)).alias("any_key"), F.max_by("price", F.when(live, key)).alias("any_price"),
        F.max_by("traded_at", F.when(live, key)).alias("any_at"))


def newest_parts(versions: DataFrame, order: Column) -> DataFrame:
    """The newest version of each part, by ``order``."""
    keys = [*SESSION_KEYS, "slot"]
    rest = [c for c in versions.columns if c not in (*keys, "batch_id")]
    return versions.withColumn("_order", order).groupBy(*keys).agg(*[F.max_by(c, "_order").alias(c) for c in rest])


def combine(parts: DataFrame) -> DataFrame:
    """One row per session: its summary columns, its latest complete trade (``last_*``) and its
    latest trade whatever it lacks (``any_*``). A session without a live trade has trades = 0."""
    def pick(side, value, key):
        return side(value, key).alias(value)

    return parts.groupBy(*SESSION_KEYS).agg(
        pick(F.min_by, "open", "open_key"), F.max("high").alias("high"), F.min("low").alias("low"),
        pick(F.max_by, "close", "close_key"), F.sum("quantity").cast("bigint").alias("quantity"),
        F.sum("financial_volume").cast(VOLUME).alias("financial_volume"), F.sum("trades").cast("bigint").alias("trades"),
        pick(F.max_by, "last_price", "last_key"), pick(F.max_by, "last_at", "last_key"), F.max("last_key").alias("last_key"),
        pick(F.max_by, "any_price", "any_key"), pick(F.max_by, "any_at", "any_key"), F.max("any_key").alias("any_key"))


def summaries(sessions: DataFrame) -> DataFrame:
    return sessions.where("trades > 0").select(*SUMMARY_COLUMNS)


def latest_complete(sessions: DataFrame) -> DataFrame:
    """The latest complete trade per session, as ``views.session_last`` gives it."""
    return sessions.where("last_key is not null").select(
        *SESSION_KEYS, F.col("last_price").alias("price"), F.col("last_at").alias("traded_at"),
        F.col("last_key").alias("latest_key"))


def incomplete_latest(sessions: DataFrame) -> DataFrame:
    """Sessions whose latest live trade has no price or no time (K7)."""
    return sessions.where("any_key is not null and (last_key is null or any_key > last_key)").select(
        *SESSION_KEYS, F.col("any_price").alias("price"), F.col("any_at").alias("traded_at"))
