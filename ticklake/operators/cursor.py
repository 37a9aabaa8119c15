"""Per-session publish cursor: turns cumulative snapshots into an incremental stream.

A cursor row holds the highest trade id already published for one (ticker, trade_date).
Ids are sequential per instrument within a session, so the key includes the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.text import cursor_key
from ticklake.schemas import ACTION_CANCELLED

KEYS = ["ticker", "trade_date"]
CURSOR_VALUE = T.StructType([T.StructField("max_trade_id", T.LongType())])


def mark_new(trades: DataFrame, cursor: DataFrame) -> DataFrame:
    """``filter_new`` as a flag: every trade with ``is_new`` (would be published)."""
    c = cursor.select(*KEYS, F.col("max_trade_id").alias("_cursor"))
    is_new = (F.col("action") == ACTION_CANCELLED) | (
        F.col("trade_id") > F.coalesce(F.col("_cursor"), F.lit(0)))
    return trades.join(c, KEYS, "left").withColumn("is_new", is_new).drop("_cursor")


def filter_new(trades: DataFrame, cursor: DataFrame) -> DataFrame:
    """Keep trades above their session's cursor (strict ``>``, missing cursor = 0).

    Cancellations always pass: they reuse the id of the trade they cancel. The cursor is
    compared with its value *before* this batch, so duplicates inside one file all pass
    (the dedup view collapses them). Plain left join: the cursor is one row per session,
    and AQE turns the join into a broadcast only when the measured side is small.
    """
    c = cursor.select(*KEYS, F.col("max_trade_id").alias("_cursor"))
    return (trades.join(c, KEYS, "left")
            .filter((F.col("action") == ACTION_CANCELLED)
                    | (F.col("trade_id") > F.coalesce(F.col("_cursor"), F.lit(0))))
            .drop("_cursor"))


def updates(published: DataFrame) -> DataFrame:
    """Highest published id per session, ignoring cancellations, floor 0."""
    return (published.filter(F.col("action") != ACTION_CANCELLED)
            .groupBy(*KEYS)
            .agg(F.greatest(F.max("trade_id"), F.lit(0).cast("bigint")).alias("max_trade_id"))
            .select(cursor_key(F.col("ticker"), F.col("trade_date")).alias("key"), *KEYS,
                    "max_trade_id"))


def advance(cursor: DataFrame, upd: DataFrame) -> DataFrame:
    """Cursor after a batch: the max of old and new per session (monotone, so equivalent
    to writing back only newly published ids, and safe under replays)."""
    old = cursor.select(*KEYS, F.col("max_trade_id").alias("_old"))
    new = upd.select(*KEYS, F.col("max_trade_id").alias("_new"))
    return (old.join(new, KEYS, "full")
            .select(cursor_key(F.col("ticker"), F.col("trade_date")).alias("key"), *KEYS,
                    F.greatest("_old", "_new").alias("max_trade_id")))


def value_json(df: DataFrame) -> DataFrame:
    """cursor record (key, JSON value) as published to the compacted log."""
    return df.select("key", F.to_json(F.struct("max_trade_id")).alias("value"))


def fold_log(log: DataFrame, *also: str) -> DataFrame:
    """Replay a compacted key/value log; the last record per key wins and a NULL
    value (tombstone) deletes the key. Order = (partition, offset). ``also``: columns that
    the key determines and that are kept."""
    last = (log.groupBy("key", *also)
            .agg(F.max_by("value", F.struct("partition", "offset")).alias("value")))
    return (last.filter(F.col("value").isNotNull())
            .select("key", *also, F.from_json("value", CURSOR_VALUE)["max_trade_id"].alias("max_trade_id")))
