"""Ingest job: landed archives -> parsed trades -> cursor filter -> event log.

One ``foreachBatch`` query over newly landed zip archives. Per micro-batch:
  1. unzip and parse every line once; the parsed lines are written to the shared folder, as the
     good, the malformed and the unreadable branches read columns of them;
  2. dead letters (and unreadable archives) go to the dead-letter log (K2);
  3. trades above their session's cursor (cancellations always) are published to the
     event log as compact JSON keyed by ticker (K1/P9); a trade that several files of the
     batch list is published once, so cumulative snapshots may share a batch;
  4. one audit row per landed file is written, also for files without a good line (A13);
  5. only after the events are written, the batch's cursor records are (K3), as the
     (key, JSON value) records of a compacted log;
  6. the published ids are kept as intervals, and ids below the cursor that no interval has
     (which the cursor alone would let vanish) are listed (T6).
Every output is partitioned by ``batch_id`` and written with dynamic overwrite. Batch N
reads only cursor records of batches below N, so a batch that is delivered again, at
whatever step it broke off, sees the same cursor and rewrites the same rows. The cursor's log
is folded by ``cursor_log(paths).compact``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import audit, cursor, intervals, parse
from ticklake.schemas import ACTION_CANCELLED, SOURCE_EOD
from ticklake.session import shared_dir
from ticklake.sinks import pointer
from ticklake.sinks.cursor_log import CursorLog
from ticklake.sinks.keyed import replace_partitions
from ticklake.sources.archives import archive_lines


@dataclass(frozen=True)
class IngestPaths:
    base: str

    @property
    def landing(self) -> str:
        return f"{self.base}/landing"

    @property
    def event_log(self) -> str:
        return f"{self.base}/event_log"

    @property
    def dead_letters(self) -> str:
        return f"{self.base}/dead_letters"

    @property
    def cursor(self) -> str:
        return f"{self.base}/cursor"

    @property
    def audit(self) -> str:
        return f"{self.base}/publish_audit"

    @property
    def intervals(self) -> str:
        return f"{self.base}/published_ids"

    @property
    def late(self) -> str:
        return f"{self.base}/late_ids"

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/_checkpoints/ingest"


def cursor_log(paths: IngestPaths) -> CursorLog:
    """The cursor's log; ``cursor_log(paths).compact(spark)`` folds it (any time, by one job)."""
    return CursorLog(paths.cursor, {"trade_date": "date", "ticker": "string"})


def cursor_before(spark: SparkSession, paths: IngestPaths, batch_id: int, days: DataFrame) -> DataFrame:
    """The cursor of the sessions of ``days`` (one column ``trade_date``) before a batch."""
    log = cursor_log(paths).records(spark, before=batch_id).join(days, "trade_date", "left_semi")
    return cursor.fold_log(log, *cursor.KEYS).select(*cursor.KEYS, "max_trade_id")


def listed_ids(trades: DataFrame) -> DataFrame:
    """(ticker, trade_date, trade_id, several): each id that trades (not cancellations) list, and
    whether several files do. Files are told apart by 64-bit hashes, so the partial
    aggregates hold numbers only and no trade is sorted or shuffled whole."""
    file = F.xxhash64("landed_at", "archive")
    return trades.where(F.col("action") != ACTION_CANCELLED).groupBy(*cursor.KEYS, "trade_id").agg(
        (F.min(file) < F.max(file)).alias("several"))


def mark_new_by_file(trades: DataFrame, before: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """``cursor.mark_new`` where a trade that several files of the batch list is new in the first
    of them only (by landing time), whatever session they were landed for. Ids are compared one
    by one, so no trade is lost when the files of a batch split a session's ids between them.
    ``first``: ``first_listed`` of the ids that several files list (None: there are none)."""
    marked = cursor.mark_new(trades, before)
    if first is None:
        return marked
    known = F.when(F.col("action") != ACTION_CANCELLED, F.struct("landed_at", "archive"))
    marked = marked.join(first, [*cursor.KEYS, "trade_id"], "left")
    relisted = F.coalesce(known > F.col("_first"), F.lit(False))
    return marked.withColumn("is_new", F.col("is_new") & ~relisted).drop("_first")


def first_listed(trades: DataFrame, ids: DataFrame) -> DataFrame:
    """Of ids (ticker, trade_date, trade_id), the first file that lists a trade (no cancellation)."""
    keys = [*cursor.KEYS, "trade_id"]
    return trades.where(F.col("action") != ACTION_CANCELLED).join(ids.select(*keys), keys).groupBy(*keys).agg(
        F.min(F.struct("landed_at", "archive")).alias("_first"))


def process_batch(paths: IngestPaths, archives: DataFrame, batch_id: int,
                  source: str = "eod_file", tracked: DataFrame | None = None) -> None:
    """``tracked``: the watchlist (J9); archives of other tickers are then left out."""
    spark = archives.sparkSession
    work = shared_dir(spark, f"ingest-batch-{uuid.uuid4().hex[:12]}")

    def keep(df: DataFrame, name: str) -> DataFrame:
        """``df``, written: its readers take the columns they need, and small tables have a known size."""
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    if tracked is not None:
        archives = archives.join(tracked.select("ticker").distinct(), "ticker", "left_semi")
    try:
        bid = F.lit(batch_id)
        # unzipped and parsed once; the rows without a line are those of unreadable and of empty archives
        parsed = keep(parse.parse_lines(archive_lines(archives, source)), "parsed")
        # K2: malformed lines and unreadable archives
        bad = parse.dead_letters(parse.bad_rows(parsed.where("raw_line is not null").drop("archive_error")))
        broken = parsed.filter(F.col("archive_error").isNotNull()).select(
            F.lit(1).alias("schema_version"), F.col("file_ticker").alias("ticker"), "session_date",
            "filename", "source", F.col("archive_error").alias("error"),
            F.lit(None).cast("string").alias("raw_line"))
        dlq = parse.dead_letter_json(bad.unionByName(broken)).withColumn("batch_id", bid)
        replace_partitions(dlq, paths.dead_letters, ["batch_id"], cluster=False)

        # P9 + K1: publish above the cursor as it was before this batch
        good = parse.good_rows(parsed.drop("archive_error"))
        days = keep(good.select("trade_date").distinct(), "days")
        before = keep(cursor_before(spark, paths, batch_id, days), "before")
        ids = keep(listed_ids(good), "ids")
        several = ids.where("several")
        if several.isEmpty():
            marked = mark_new_by_file(good, before)
        else:
            first = keep(first_listed(good, keep(several, "several")), "first")
            marked = keep(mark_new_by_file(good, before, first), "marked")
        published = marked.filter("is_new").drop("is_new", "landed_at", "archive")
        events = parse.trade_event_json(published, F.col("source")).withColumn("batch_id", bid)
        replace_partitions(events, paths.event_log, ["batch_id"], cluster=False)

        # One row per landed file of the batch, with zeros where it holds no good line
        every = parsed.filter(F.col("archive_error").isNull()).select(
            F.col("file_ticker").alias("ticker"), "session_date", "filename").distinct()
        told = audit.publish_audit_of(marked, keep(audit.file_counts(marked), "counts"))
        rows = every.join(told, ["ticker", "session_date", "filename"], "left").fillna(
            0, ["total", "published"]).withColumn("batch_id", bid)
        replace_partitions(rows, paths.audit, ["batch_id"], cluster=False)

        # K3: the cursor moves only after the events are durable
        after = cursor.updates(published)
        record = cursor.value_json(after).join(after.select("key", *cursor.KEYS), "key")
        record = record.withColumns({"partition": F.lit(0), "offset": bid.cast("long")})
        cursor_log(paths).append(record, batch_id)

        # Ids below the cursor that were never published are listed, not lost. Every id above the
        # cursor was published, by the first file that lists it
        above = cursor.mark_new(ids.withColumn("action", F.lit(0)), before).where("is_new")
        own = intervals.islands(above, once=True).withColumn("batch_id", bid)
        replace_partitions(own, paths.intervals, ["trade_date", "batch_id"])
        sent = spark.read.schema(own.schema).parquet(paths.intervals).where(F.col("batch_id") <= batch_id).join(
            days, "trade_date", "left_semi")
        missed = intervals.late(marked, sent).select(*cursor.KEYS, "trade_id", "filename").withColumn("batch_id", bid)
        replace_partitions(missed, paths.late, ["batch_id"], cluster=False)
    finally:
        pointer.delete(spark, work)


def backfill(spark: SparkSession, paths: IngestPaths, landed: DataFrame, calendar: DataFrame, batch_id: int,
             tracked: DataFrame | None = None) -> None:
    """The final files of the calendar's sessions (``session_date``) go through ingest as
    ``eod_file``: what an earlier poll missed is published, what it published is not. The same
    batch id again, after a failure, writes the same rows; a later one publishes no new trade."""
    days = calendar.select("session_date").distinct()
    files = landed.withColumn("session_date", F.col("session_date").cast("date"))
    process_batch(paths, files.join(days, "session_date", "left_semi"), batch_id, SOURCE_EOD, tracked)


def start(spark: SparkSession, paths: IngestPaths, archive_schema, source: str = "eod_file",
          available_now: bool = True, tracked: DataFrame | None = None):
    from ticklake.sources.archives import stream_archives
    stream = stream_archives(spark, paths.landing, archive_schema)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: process_batch(paths, df, bid, source, tracked))
              .option("checkpointLocation", paths.checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 minutes")
    return writer.start()
