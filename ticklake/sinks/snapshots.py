"""content digests stored by version, and the feed of what changed between two of them.

A version holds one (ticker, digest) row per document. It is written next to the versions
before it and then named by the pointer, so readers compare whole versions, and a version
written again replaces itself. The feed of a version costs two narrow scans, not two builds of
all documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.sinks import pointer


def store(digests: DataFrame, base: str, key: str = "ticker", digest: str = "etag") -> int:
    """Write the digests of a new version; returns its number (from 1)."""
    spark = digests.sparkSession
    version = latest(spark, base) + 1
    rows = digests.select(F.col(key).alias("key"), F.col(digest).alias("digest"))
    rows.write.mode("overwrite").parquet(f"{base}/{version}")
    pointer.publish(spark, f"{base}/current.json", {"version": version})
    return version


def latest(spark: SparkSession, base: str) -> int:
    """The newest whole version; 0 if there is none."""
    return (pointer.resolve(spark, f"{base}/current.json") or {"version": 0})["version"]


def _version(spark: SparkSession, base: str, version: int) -> DataFrame:
    if version < 1:
        return spark.createDataFrame([], "key string, digest string")
    return spark.read.schema("key string, digest string").parquet(f"{base}/{version}")


def changes(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """(key, change, digest_before, digest_now) of a version against the one before it: ``added``,
    ``changed`` or ``gone`` keys; equal ones do not appear."""
    version = latest(spark, base) if version is None else version
    before, now = _version(spark, base, version - 1), _version(spark, base, version)
    both = before.withColumnRenamed("digest", "digest_before").withColumn("_b", F.lit(1)).join(
        now.withColumnRenamed("digest", "digest_now").withColumn("_n", F.lit(1)), "key", "full")
    change = (F.when(F.col("_b").isNull(), "added").when(F.col("_n").isNull(), "gone")
              .when(~F.col("digest_before").eqNullSafe(F.col("digest_now")), "changed"))
    return both.withColumn("change", change).where("change is not null").select(
        "key", "change", "digest_before", "digest_now")
