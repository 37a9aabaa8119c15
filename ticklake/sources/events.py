"""Event-log sources: lenient JSON decode of trade events (batch and streaming).

``from_json`` in PERMISSIVE mode never stalls a stream: a shape-mismatched document gives
an all-NULL row, a wrong-typed field gives NULL for that field only. Downstream views guard
the key columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.timefmt import decode_instant
from ticklake.schemas import TRADE_EVENT_COLUMNS, TRADE_EVENT_SCHEMA

_JSON_OPTIONS = {"mode": "PERMISSIVE", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}


def decode_values(df: DataFrame, schema: T.StructType | str, value_col: str = "value") -> DataFrame:
    """Decode a JSON text column into top-level columns; the other columns are kept."""
    keep = [c for c in df.columns if c != value_col]
    return (df.select(*keep, F.from_json(F.col(value_col), schema, _JSON_OPTIONS).alias("_j"))
              .select(*keep, "_j.*"))


def decode_trade_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Event JSON -> typed bronze rows; ``traded_at`` becomes a UTC wall clock (NTZ)
    whatever the session time zone."""
    decoded = decode_values(raw, TRADE_EVENT_SCHEMA, value_col)
    keep = [c for c in decoded.columns if c not in TRADE_EVENT_COLUMNS]
    return decoded.select(
        *keep,
        *[decode_instant(F.col(c)).alias(c) if c == "traded_at" else F.col(c)
          for c in TRADE_EVENT_COLUMNS])


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of an event log: parquet records (key, value JSON), like a topic's
    records; extra columns (e.g. the ``batch_id`` partition) are kept."""
    return decode_trade_events(spark.read.parquet(path).drop("key"))


def stream_event_log(spark: SparkSession, path: str, partition_col: str = "batch_id",
                     max_files: int | None = None) -> DataFrame:
    """Streaming scan of the same log from the earliest file; the file source keeps its
    offsets in the query checkpoint. A Kafka source plugs in the same way when the
    connector is on the classpath: ``readStream.format('kafka')...select(value cast string)``."""
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
                           T.StructField(partition_col, T.IntegerType())])
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return decode_trade_events(reader.load(path).drop("key", partition_col))
