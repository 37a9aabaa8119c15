"""Drive the serve job over an event log that lands in several drops.

Each drop is a set of JSON-lines files; after each drop the serve query runs with an
``availableNow`` trigger on the same checkpoint, the way a scheduler would trigger it as
files arrive. Used by the catalogue's streaming queries and by the tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators.parse import event_log_json
from ticklake.session import shared_dir
from ticklake.sources.events import stream_event_log
from ticklake.streaming import serve


def run_serve_over_drops(spark: SparkSession, events: DataFrame, drop_of, n_drops: int,
                         run_dir: str | None = None) -> serve.ServePaths:
    run_dir = run_dir or shared_dir(spark, f"serve-{uuid.uuid4().hex[:12]}")
    paths = serve.ServePaths(run_dir)
    log_dir = f"{run_dir}/event_log"
    tagged = events.withColumn("_drop", drop_of)
    for k in range(n_drops):
        drop = tagged.filter(F.col("_drop") == k)
        event_log_json(drop).withColumn("drop", F.lit(k)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("drop").parquet(log_dir)
        stream = stream_event_log(spark, log_dir, partition_col="drop")
        q = serve.start(spark, stream, paths, available_now=True)
        q.awaitTermination()
    return paths


def run_cursor_over_drops(spark: SparkSession, trades: DataFrame, drop_of, n_drops: int,
                          run_dir: str | None = None) -> str:
    """Land typed trades in ``n_drops`` drops and run the cursor stream after each; returns the
    path of the published trades."""
    from ticklake.streaming import cursor_state
    run_dir = run_dir or shared_dir(spark, f"cursor-{uuid.uuid4().hex[:12]}")
    tagged = trades.withColumn("drop", drop_of)
    schema = tagged.schema
    for k in range(n_drops):
        tagged.filter(F.col("drop") == k).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("drop").parquet(f"{run_dir}/in")
        stream = spark.readStream.schema(schema).parquet(f"{run_dir}/in")
        cursor_state.start(stream, run_dir, f"{run_dir}/_checkpoints/cursor").awaitTermination()
    return cursor_state.published_path(run_dir)


def run_counts_over_drops(spark: SparkSession, events: DataFrame, drop_of, n_drops: int,
                          run_dir: str | None = None) -> str:
    """Land the event log in drops and run the streaming event-count aggregation after
    each; returns the gold table path."""
    from ticklake.streaming import counts
    run_dir = run_dir or shared_dir(spark, f"counts-{uuid.uuid4().hex[:12]}")
    log_dir, out = f"{run_dir}/event_log", f"{run_dir}/gold/session_event_counts"
    tagged = events.withColumn("_drop", drop_of)
    for k in range(n_drops):
        event_log_json(tagged.filter(F.col("_drop") == k)).withColumn("drop", F.lit(k)) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("drop").parquet(log_dir)
        stream = stream_event_log(spark, log_dir, partition_col="drop")
        counts.start(spark, stream, out, f"{run_dir}/_checkpoints/counts").awaitTermination()
    return out
