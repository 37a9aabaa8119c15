"""Published ids as interval sets, and the ids that a cursor let vanish.

A cursor is one number per session: an id below it that was never published looks like one
that was. The published ids of a session are kept as intervals (gaps and islands), so such
late ids can be told from re-deliveries, counted and listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.operators.cursor import KEYS
from ticklake.schemas import ACTION_CANCELLED

#: Bits of an id within a block; an interval never leaves its block, so no window sorts a hot session.
BLOCK_BITS = 16


def _block(trade_id: str):
    return F.shiftright(trade_id, BLOCK_BITS)


def islands(ids: DataFrame, once: bool = False) -> DataFrame:
    """(ticker, trade_date, block, first_id, last_id): the ids of each session as intervals of
    consecutive ids, cut at block ends. ``once``: no id of a session is listed twice."""
    ids = ids.select(*KEYS, "trade_id").where("trade_id is not null")
    ids = (ids if once else ids.distinct()).withColumn("block", _block("trade_id"))
    place = F.row_number().over(Window.partitionBy(*KEYS, "block").orderBy("trade_id"))
    return ids.withColumn("_gap", F.col("trade_id") - place).groupBy(*KEYS, "block", "_gap").agg(
        F.min("trade_id").alias("first_id"), F.max("trade_id").alias("last_id")).drop("_gap")


def merged(intervals: DataFrame) -> DataFrame:
    """Intervals (first_id, last_id) of each session with those that touch or overlap joined, across
    blocks too; ``ids`` counts the ids."""
    rows = intervals.select(*KEYS, "first_id", "last_id")
    before = Window.partitionBy(*KEYS).orderBy("first_id", "last_id").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*KEYS).orderBy("first_id", "last_id")
    starts = F.coalesce(F.col("first_id") > F.max("last_id").over(before) + 1, F.lit(True))
    rows = rows.withColumn("_new", starts.cast("int")).withColumn("_group", F.sum("_new").over(upto))
    return rows.groupBy(*KEYS, "_group").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")).select(
        *KEYS, "first_id", "last_id", (F.col("last_id") - F.col("first_id") + 1).alias("ids"))


def late(marked: DataFrame, published: DataFrame) -> DataFrame:
    """Trades that the cursor holds back (``is_new`` false) although no published interval has their
    id. ``published``: rows of :func:`islands`."""
    held = marked.where(~F.col("is_new") & (F.col("action") != ACTION_CANCELLED)).withColumn("block", _block("trade_id"))
    return held.join(published, (F.col("trade_id") >= published["first_id"]) & (F.col("trade_id") <= published["last_id"])
                     & (held["block"] == published["block"])
                     & (held["ticker"] == published["ticker"]) & (held["trade_date"] == published["trade_date"]),
                     "left_anti").drop("block", "is_new")
