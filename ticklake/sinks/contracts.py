"""K7 on write: rows are checked in the pass that writes them.

A contract names the columns that must not be null and further conditions of a row. The write
goes to two partitions, ``ok=true`` for what readers get and ``ok=false`` for the quarantine,
where a row carries the rules it broke; the counts per rule are metrics of the same pass. Keys
that repeat need the rows of a key together: they are counted on the written keys alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write(rows: DataFrame, path: str, not_null: list[str], conditions: dict[str, Column] | None = None) -> dict[str, int]:
    """Write checked rows; returns the violations per rule (and ``rows``, all that came)."""
    rules = {f"not null {c}": F.col(c).isNotNull() for c in not_null}
    rules |= {name: F.coalesce(condition, F.lit(False)) for name, condition in (conditions or {}).items()}
    broken = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))
    checked = rows.withColumn("broken_rules", broken)
    seen = Observation()
    counted = checked.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.array_contains("broken_rules", name)).alias(f"r{k}") for k, name in enumerate(rules)])
    counted.withColumn("ok", (F.size("broken_rules") == 0).cast("string")).write.mode("overwrite").partitionBy("ok").parquet(path)
    got = seen.get
    return {"rows": got["rows"], **{name: got[f"r{k}"] for k, name in enumerate(rules)}}


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows that keep the contract."""
    return spark.read.parquet(path).where("ok = 'true'").drop("ok", "broken_rules")


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The rows that do not, with ``broken_rules``."""
    return spark.read.parquet(path).where("ok = 'false'").drop("ok")


def repeated_keys(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """(keys, n) of the keys that more than one row holds, over good and quarantined rows."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
