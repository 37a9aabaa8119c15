"""The publish cursor of a stream of trades, its state in two levels.

Per micro-batch the trades meet the cursor as it was *before* the batch (so duplicates inside
one snapshot all pass and the dedup view collapses them; cancellations always pass), and what
passes is written. Then each task's highest published id per session is one row of a partial
aggregate (the first level, as many rows of a hot session as tasks saw it), and their maximum
is the session's one record of the batch in the cursor's log (the second). The log is folded
every few batches, so the state a batch reads is one small row per session of its days.

Trades never gather by session: the join with the one-row-per-session cursor broadcasts or
splits, so a session that holds a third of all trades is spread over all tasks, and no row
passes through Python. A batch delivered again reads the same cursor and rewrites its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import cursor
from ticklake.session import shared_dir
from ticklake.sinks.cursor_log import CursorLog
from ticklake.sinks.keyed import replace_partitions

#: Batches after which the cursor's log is folded.
FOLD_EVERY = 8


def published_path(base: str) -> str:
    return f"{base}/published"


def state(base: str) -> CursorLog:
    return CursorLog(f"{base}/cursor", {"trade_date": "date", "ticker": "string"})


def cursor_before(spark: SparkSession, base: str, batch_id: int | None = None) -> DataFrame:
    """(ticker, trade_date, max_trade_id) before a batch, or after the last one."""
    folded = cursor.fold_log(state(base).records(spark, before=batch_id), *cursor.KEYS)
    return folded.select(*cursor.KEYS, "max_trade_id")


def process_batch(base: str, trades: DataFrame, batch_id: int) -> None:
    spark = trades.sparkSession
    shared_dir(spark, "lineage")
    before = cursor_before(spark, base, batch_id)
    passed = cursor.filter_new(trades, before).withColumn("batch_id", F.lit(batch_id))
    replace_partitions(passed, published_path(base), ["batch_id"], cluster=False)
    own = spark.read.schema(passed.schema).parquet(published_path(base)).where(F.col("batch_id") == batch_id)
    highest = cursor.updates(own)
    record = cursor.value_json(highest).join(highest.select("key", *cursor.KEYS), "key")
    state(base).append(record.withColumns({"partition": F.lit(0), "offset": F.lit(batch_id).cast("long")}), batch_id)
    if batch_id % FOLD_EVERY == FOLD_EVERY - 1:
        state(base).compact(spark)


def start(trades: DataFrame, base: str, checkpoint: str):
    """Publish a streaming frame of trades to ``published_path(base)``, partitioned by batch."""
    return (trades.writeStream.foreachBatch(lambda df, bid: process_batch(base, df, bid))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
