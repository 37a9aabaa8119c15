"""Scans of the driver's parquet tables and of our own gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str,
          parallel: bool = False) -> DataFrame:
    """Read one driver table (Catalyst prunes the parquet ReadSchema to the columns the
    plan uses). ``parallel`` spreads a scan that arrived in too few splits, see ``spread``;
    pass the needed ``columns`` with it so only those are redistributed."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df) if parallel else df


def gold(spark: SparkSession, path: str, live_only: bool = True) -> DataFrame:
    """Scan a gold table written by ``ticklake.sinks``. Marker rows (groups emptied by a
    retraction) are filtered unless ``live_only`` is False."""
    df = spark.read.parquet(path)
    if live_only and "is_marker" in df.columns:
        df = df.filter("NOT is_marker").drop("is_marker")
    return df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan over the cluster when it arrived in hardly more splits than there are
    cores, so CPU-heavy per-row work (line parsing) runs in parallel: such splits are cut to the
    number of cores, and where a row group is larger than a split most of them are empty. A
    scan of twice as many splits, of full size, is returned untouched: no extra shuffle at scale."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * want:
        return df
    return df.repartition(want)
