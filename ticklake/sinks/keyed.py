"""Keyed replace on plain parquet (no MERGE-capable table format needed).

A gold table is partitioned by the key it is recomputed by. A job rewrites exactly the
partitions it touched with dynamic partition overwrite. Because dynamic overwrite leaves a
partition alone when the new result for it is empty, every touched key that lost all its
rows is written as a marker row (``is_marker = true``); readers filter markers out.
Rewriting a partition twice with the same input gives the same files' content, so a
replayed micro-batch is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_markers(touched_keys: DataFrame, result: DataFrame, keys: list[str]) -> DataFrame:
    """Every touched key appears: its result rows, or one marker row with NULL values."""
    live = result.withColumn("is_marker", F.lit(False))
    gone = touched_keys.select(*keys).distinct().join(result.select(*keys).distinct(), keys, "left_anti")
    markers = gone.select(*keys, *[F.lit(None).cast(f.dataType).alias(f.name)
                                   for f in result.schema.fields if f.name not in keys],
                          F.lit(True).alias("is_marker"))
    return live.unionByName(markers)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str],
                       cluster: bool = True) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition overwrite).

    ``cluster`` groups rows by the partition columns before writing with AQE's rebalance
    (few, reasonably sized files per partition) which, unlike a plain repartition, splits a
    skewed partition over several writers, so a hot day is never funnelled through one
    task. Without it every producing task writes its own file per partition.
    """
    if cluster:
        df = df.hint("rebalance", *partition_by)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by)
       .parquet(path))


def exists(spark, path: str) -> bool:
    """True when a parquet table has been written at ``path`` (a directory listing through
    Hadoop's FileSystem of the path's own scheme, so it works on shared storage)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)
