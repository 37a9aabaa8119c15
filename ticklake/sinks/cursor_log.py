"""The publish cursor as a compacted log: a folded base and a tail.

Jobs append (key, value, partition, offset) records by batch, a null value being a tombstone.
``compact`` folds all batches up to one into a base (the last record of each key, none for a
key whose last record is a tombstone) and names it in the pointer; records of the tail, and
with them the tombstones, go only when the older of the two bases that are kept covers them.

A batch reads what batches before it left: the newest base below it and the tail in between.
A batch that may be delivered again is the newest one, which is never folded, so it reads the
same cursor each time, before and after a compaction.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.sinks import pointer
from ticklake.sinks.keyed import exists, replace_partitions

RECORD = {"key": "string", "value": "string", "partition": "int", "offset": "long"}


@dataclass(frozen=True)
class CursorLog:
    """A log at ``path`` whose records carry the further columns ``extra`` ({name: type}), by
    the first of which (if any) base and tail are partitioned."""

    path: str
    extra: dict = field(default_factory=dict)

    @property
    def pointer(self) -> str:
        return f"{self.path}_base/current.json"

    @property
    def columns(self) -> dict:
        return {**RECORD, **self.extra}

    def append(self, records: DataFrame, batch_id: int) -> None:
        """Write the records of a batch, in place of those it wrote when it was delivered before."""
        rows = records.select(*self.columns).withColumn("batch_id", F.lit(batch_id))
        replace_partitions(rows, self.path, [*list(self.extra)[:1], "batch_id"])

    def _read(self, spark: SparkSession, path: str, more: str = "") -> DataFrame:
        schema = ", ".join(f"{c} {t}" for c, t in self.columns.items()) + more
        if not exists(spark, path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path)

    def _tail(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self.path, ", batch_id int")

    def records(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The records that decide the cursor before a batch (of the whole log by default)."""
        now = pointer.resolve(spark, self.pointer) or {"bases": [], "floor": -1}
        bases = [b for b in now["bases"] if before is None or b["upto"] < before]
        if not bases and now["floor"] >= 0:
            raise ValueError(f"the records that batch {before} read are folded (up to batch {now['floor']})")
        upto = bases[-1]["upto"] if bases else -1
        tail = self._tail(spark).where(F.col("batch_id") > upto)
        if before is not None:
            tail = tail.where(F.col("batch_id") < before)
        tail = tail.select(*self.columns)
        return self._read(spark, bases[-1]["folder"]).unionByName(tail) if bases else tail

    def _last(self, records: DataFrame) -> DataFrame:
        """The last record of each key, without tombstones."""
        place = F.struct("partition", "offset")
        last = records.groupBy("key", *self.extra).agg(F.max_by(F.struct("value", "partition", "offset"), place).alias("_r"))
        return last.select("key", *self.extra, "_r.*").where("value is not null").select(*self.columns)

    def compact(self, spark: SparkSession) -> int:
        """Fold all batches but the newest; returns the last batch that the base covers (-1: none)."""
        newest = self._tail(spark).agg(F.max("batch_id")).first()[0]
        now = pointer.resolve(spark, self.pointer) or {"bases": [], "floor": -1}
        done = now["bases"][-1]["upto"] if now["bases"] else -1
        if newest is None or newest - 1 <= done:
            return done
        folder = f"{self.path}_base/{uuid.uuid4().hex}"
        writer = self._last(self.records(spark, before=newest)).write
        by = list(self.extra)[:1]
        (writer.partitionBy(*by) if by else writer).parquet(folder)
        bases = [*now["bases"][-1:], {"upto": newest - 1, "folder": folder}]
        floor = bases[0]["upto"] if len(bases) > 1 else -1
        pointer.publish(spark, self.pointer, {"bases": bases, "floor": floor})
        self._vacuum(spark, floor, [b["folder"] for b in bases])
        return newest - 1

    def _vacuum(self, spark: SparkSession, floor: int, bases: list[str]) -> None:
        """Delete the tail up to ``floor`` and the bases that the pointer no longer names."""
        by = pointer.subfolders(spark, self.path)
        for folder in by if not self.extra else [x for f in by for x in pointer.subfolders(spark, f)]:
            batch = folder.rpartition("batch_id=")[2]
            if batch.isdigit() and int(batch) <= floor:
                pointer.delete(spark, folder)
        for folder in pointer.subfolders(spark, f"{self.path}_base"):
            if folder.rpartition("/")[2] not in {b.rpartition("/")[2] for b in bases}:
                pointer.delete(spark, folder)
