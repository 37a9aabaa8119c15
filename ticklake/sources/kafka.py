"""Kafka as the event log (S4, S6, K1-K3), when the connector is on the classpath.

The records are the same ``(key, value)`` pairs the parquet event log stores: trade events
keyed by ticker, dead letters keyed by ticker, cursor records keyed by
``ticker:trade_date``. The Spark Kafka connector is not bundled with this install, so these
functions are exercised only where it is deployed (``available()`` tells); everything else
in the library uses the parquet log with the same record shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.sources.events import decode_trade_events


def available(spark: SparkSession) -> bool:
    """True when the Kafka data source resolves in this session. ``load()`` only resolves
    the source; a Kafka batch read connects when it is executed, so nothing is contacted."""
    try:
        (spark.read.format("kafka").option("kafka.bootstrap.servers", "localhost:9")
         .option("subscribe", "probe").load())
        return True
    except Exception as exc:  # noqa: BLE001
        if "kafka" in str(exc).lower() and ("not found" in str(exc).lower()
                                            or "failed to find" in str(exc).lower()):
            return False
        raise


def _records(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     "partition", "offset")


def read_log(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Batch read of a whole topic, earliest to latest (e.g. the compacted cursor log,
    folded with ``operators.cursor.fold_log``)."""
    df = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", topic).option("startingOffsets", "earliest")
          .option("endingOffsets", "latest").load())
    return _records(df)


def stream_trade_events(spark: SparkSession, servers: str, topic: str,
                        max_offsets: int | None = None) -> DataFrame:
    """The trade-event topic from the earliest offset, leniently decoded; offsets are
    tracked in the streaming query's checkpoint."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return decode_trade_events(_records(reader.load()).drop("partition", "offset"))


def write_records(df: DataFrame, servers: str, topic: str) -> None:
    """K1/K2/K3: publish ``(key, value)`` records; a failed delivery fails the Spark write
    (and so the micro-batch), so callers never advance state past an unconfirmed write."""
    (df.select(F.col("key").cast("string"), F.col("value").cast("string"))
       .write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())
