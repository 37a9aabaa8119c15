"""The tracked-company dimension as a small constant DataFrame.

Bounded by construction (one row per tracked company), so joins may broadcast it
explicitly. ``position`` keeps the declaration order: on a duplicated issuer the later
entry wins (J4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.schemas import WATCHLIST, WATCHLIST_SCHEMA


def watchlist(spark: SparkSession) -> DataFrame:
    rows = [(*entry, i) for i, entry in enumerate(WATCHLIST)]
    schema = T.StructType([*WATCHLIST_SCHEMA.fields, T.StructField("position", T.IntegerType(), False)])
    return spark.createDataFrame(rows, schema)


def tracked(df: DataFrame, spark: SparkSession, ticker_col: str = "ticker") -> DataFrame:
    """Keep only rows of tracked tickers (left semi join on the broadcast dimension)."""
    dim = F.broadcast(watchlist(spark).select(F.col("ticker").alias(ticker_col)))
    return df.join(dim, ticker_col, "left_semi")
