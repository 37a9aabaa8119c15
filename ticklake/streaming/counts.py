"""A1 as a native stateful streaming aggregation.

Event counts per (ticker, trade_date) only ever grow (re-deliveries are counted, nothing is
retracted), so Structured Streaming's own aggregation state (RocksDB store, checkpointed)
keeps them: ``update`` mode emits just the keys a micro-batch changed, with their running
totals. Each micro-batch then rewrites the touched day partitions of the gold table,
carrying over the untouched keys of those days. No watermark: late events are never
dropped, as in the source views (state grows with the number of sessions, not events).

The totals live in the query's checkpoint; ``heal`` reads them back with Spark's state data
source and rewrites the days of the gold table that differ, lost partitions included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import views
from ticklake.session import shared_dir
from ticklake.sinks.keyed import exists, replace_partitions
from ticklake.sinks.pointer import subfolders
from ticklake.sources.tables import gold


def _apply(path: str, changed: DataFrame, batch_id: int) -> None:
    spark = changed.sparkSession
    shared_dir(spark, "lineage")  # checkpoint() below needs the shared folder
    changed = changed.checkpoint(eager=True)
    days = [r[0] for r in changed.select("trade_date").distinct().collect()]  # a few dates
    out = changed.withColumn("is_marker", F.lit(False))
    if exists(spark, path) and days:
        touched_day = F.col("trade_date").isin([d for d in days if d is not None])
        if None in days:  # events without a session are counted too (no key guard in A1)
            touched_day = touched_day | F.col("trade_date").isNull()
        old = gold(spark, path, live_only=False).filter(touched_day)
        new = changed.select(F.col("ticker").alias("_t"), F.col("trade_date").alias("_d"))
        kept = old.join(new, old["ticker"].eqNullSafe(new["_t"])
                        & old["trade_date"].eqNullSafe(new["_d"]), "left_anti")
        out = out.unionByName(kept.select(*out.columns))
    replace_partitions(out.checkpoint(eager=True), path, ["trade_date"])


def totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(ticker, trade_date, events) as the streaming state of the last committed batch holds them."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.ticker", "key.trade_date", F.col("value.count").alias("events"))


def heal(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Rewrite the days of the gold table that differ from the state; returns these days.

    Run it while the query is stopped. A day is rewritten whole; days that only gold holds
    (which the state never counted) get a marker row and so read as empty.
    """
    shared_dir(spark, "lineage")
    held = totals(spark, checkpoint)
    seen = gold(spark, path) if _has_rows(spark, path) else held.limit(0)
    columns = ["trade_date", "ticker", "events"]
    wrong = held.select(columns).exceptAll(seen.select(columns)).union(
        seen.select(columns).exceptAll(held.select(columns)))
    days = wrong.select("trade_date").distinct().checkpoint(eager=True)
    right = held.join(days.withColumnRenamed("trade_date", "_day"), F.col("trade_date").eqNullSafe(F.col("_day")),
                      "left_semi").withColumn("is_marker", F.lit(False))
    gone = days.join(held.select(F.col("trade_date").alias("_day")), F.col("trade_date").eqNullSafe(F.col("_day")),
                     "left_anti").withColumn("is_marker", F.lit(True))
    replace_partitions(right.unionByName(gone, allowMissingColumns=True).checkpoint(eager=True), path, ["trade_date"])
    return days


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether the table has a partition left; without one its files tell no schema."""
    return any("=" in folder.rpartition("/")[2] for folder in subfolders(spark, path))


def start(spark: SparkSession, events: DataFrame, path: str, checkpoint: str,
          available_now: bool = True):
    counts = views.session_event_counts(events)
    writer = (counts.writeStream.outputMode("update")
              .foreachBatch(lambda df, bid: _apply(path, df, bid))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
