"""Serve job: event log -> bronze -> trade layer -> gold (session summary, latest trades, last price).

One ``foreachBatch`` query. Each micro-batch
  1. lands its decoded events in bronze, partitioned by (trade_date, batch_id);
  2. writes its trades, deduplicated, as a delta of the trade layer, partitioned by (slot,
     batch_id); a slot is a hash of the trade's key;
  3. reads from the layer only the slots and days that its trades fall into, merges the
     deltas (the largest of each column per trade) and writes the touched sessions' parts of
     these slots, a version per batch;
  4. combines the parts of the touched days, one row per (session, slot), and rewrites these
     days of gold whole; sessions without live trades become marker rows;
  5. recomputes ``last_price`` for the tickers touched in the batch.
What a batch reads of the trades is at most its own number of trades times a day's trades in a
slot, and one row per (session, slot) of the touched days; with slots sized for some hundred
trades a day this grows with the batch and not with the day. Each output of a batch overwrites
only partitions of that batch or whole days, so a batch delivered again rewrites the same rows.

Retractions (late cancellations) lower ``high``, move ``close`` or remove a session, exactly
as the batch views would. A session's latest trade without price or time is listed once, under
its (ticker, trade_date), in the violations, and the newest complete trade is served.

``compact`` folds the layer's deltas; ``rebuild`` makes every derived table anew from bronze
in a folder of its own and then switches readers and the job to it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import parts, views
from ticklake.operators.views import SESSION_KEYS
from ticklake.session import shared_dir
from ticklake.sinks import pointer
from ticklake.sinks.keyed import replace_partitions, with_markers
from ticklake.sources.tables import gold

#: Slots of the trade layer; on a cluster a day's trades divided by some hundred.
SLOTS = 16


@dataclass(frozen=True)
class ServePaths:
    base: str
    version: str = "v0"

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze"

    @property
    def trades(self) -> str:
        return f"{self.base}/{self.version}/trades"

    @property
    def parts(self) -> str:
        return f"{self.base}/{self.version}/parts"

    @property
    def summary(self) -> str:
        return f"{self.base}/{self.version}/gold/session_summary"

    @property
    def session_last(self) -> str:
        return f"{self.base}/{self.version}/gold/session_last"

    @property
    def last_price(self) -> str:
        return f"{self.base}/{self.version}/gold/last_price"

    @property
    def violations(self) -> str:
        return f"{self.base}/{self.version}/violations/last_price"

    @property
    def pointer(self) -> str:
        return f"{self.base}/current.json"

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/_checkpoints/serve"


def current(spark: SparkSession, base: str) -> ServePaths:
    """The folders that readers and the job use now."""
    paths = ServePaths(base)
    return replace(paths, **(pointer.resolve(spark, paths.pointer) or {}))


def _age(batch_id: Column) -> Column:
    """Order of the versions of a part: batch by batch, with what ``compact`` folded up to batch K
    (stored as batch ``-(K + 1)``) just before that batch's own rows."""
    return F.when(batch_id < 0, (-batch_id - 1) * 2).otherwise(batch_id * 2 + 1)


def _write_parts(state: DataFrame, paths: ServePaths, batch_id: int) -> None:
    rows = parts.session_parts(parts.merge_trades(state, "slot")).withColumn("batch_id", F.lit(batch_id))
    replace_partitions(rows.sortWithinPartitions("trade_date"), paths.parts, ["batch_id"], cluster=False)


def _write_trades(trades: DataFrame, paths: ServePaths, batch_id: int, slots: int) -> DataFrame:
    """Write a delta of the trade layer; returns the layer (whose files may hold no row yet)."""
    rows = trades.withColumns({"slot": parts.slot_of(slots), "batch_id": F.lit(batch_id)})
    replace_partitions(rows.sortWithinPartitions("slot", "trade_date"), paths.trades, ["slot", "batch_id"], cluster=False)
    return rows.sparkSession.read.schema(rows.schema).parquet(paths.trades)


def process_batch(paths: ServePaths, events: DataFrame, batch_id: int, slots: int = SLOTS) -> dict:
    """Serve one micro-batch; returns its figures: trades in it, rows of the layer it read."""
    spark = events.sparkSession
    shared_dir(spark, "lineage")  # checkpoint() below needs the shared folder
    # Bronze is written straight from the producing tasks (no shuffle of the raw events).
    landed = events.withColumn("batch_id", F.lit(batch_id))
    replace_partitions(landed, paths.bronze, ["trade_date", "batch_id"], cluster=False)
    own = spark.read.schema(landed.schema).parquet(paths.bronze).where(F.col("batch_id") == batch_id)
    layer = _write_trades(parts.trade_versions(own), paths, batch_id, slots)
    delta = layer.where(F.col("batch_id") == batch_id)
    # at most ``slots`` numbers and two dates
    reach = delta.agg(F.count(F.lit(1)).alias("n"), F.collect_set("slot").alias("slots"),
                      F.min("trade_date").alias("first"), F.max("trade_date").alias("last")).first()
    if not reach.n:
        return {"trades": 0, "read": 0}
    seen = Observation()
    state = layer.where(F.col("slot").isin(reach.slots) & F.col("trade_date").between(reach.first, reach.last))
    state = state.observe(seen, F.count(F.lit(1)).alias("rows"))
    touched = delta.select(*SESSION_KEYS, "slot").distinct()
    _write_parts(state.join(touched, [*SESSION_KEYS, "slot"], "left_semi"), paths, batch_id)
    touched = delta.select(*SESSION_KEYS).distinct().checkpoint(eager=True)
    versions = spark.read.parquet(paths.parts).where(F.col("trade_date").between(reach.first, reach.last))
    _write_gold(spark, paths, versions, touched.select("trade_date").distinct(), touched.select("ticker").distinct())
    return {"trades": reach.n, "read": seen.get["rows"]}


def _write_gold(spark: SparkSession, paths: ServePaths, versions: DataFrame, days: DataFrame, tickers: DataFrame) -> None:
    """Gold of whole days from the parts, then the last price of the given tickers."""
    newest = parts.newest_parts(versions.join(days, "trade_date", "left_semi"), _age(F.col("batch_id")))
    sessions = parts.combine(newest).checkpoint(eager=True)  # one row per session, read three times
    replace_partitions(with_markers(sessions, parts.summaries(sessions), SESSION_KEYS), paths.summary, ["trade_date"])
    replace_partitions(with_markers(sessions, parts.latest_complete(sessions), SESSION_KEYS), paths.session_last, ["trade_date"])
    replace_partitions(with_markers(days, parts.incomplete_latest(sessions), ["trade_date"]), paths.violations, ["trade_date"])
    per_session = gold(spark, paths.session_last).join(tickers, "ticker", "left_semi")
    prices = views.last_price_from_sessions(per_session).checkpoint(eager=True)
    replace_partitions(with_markers(tickers, prices, ["ticker"]), paths.last_price, ["ticker"])


def rebuild(spark: SparkSession, paths: ServePaths, slots: int = SLOTS) -> ServePaths:
    """Every derived table anew from bronze, in a folder of its own, then the switch: what bronze no
    longer holds is gone, and readers see the old tables whole until they see the new ones whole.
    The old folder stays for readers that still use it; ``pointer.delete`` removes it."""
    shared_dir(spark, "lineage")
    new = replace(paths, version=f"v-{uuid.uuid4().hex[:12]}")
    layer = _write_trades(parts.trade_versions(spark.read.parquet(paths.bronze)), new, -1, slots)
    if not layer.isEmpty():
        _write_parts(layer, new, -1)
        _write_gold(spark, new, spark.read.parquet(new.parts), layer.select("trade_date").distinct(),
                    layer.select("ticker").distinct())
    pointer.publish(spark, paths.pointer, {"version": new.version})
    return new


def compact(spark: SparkSession, paths: ServePaths, upto: int) -> None:
    """Fold the deltas and versions of batches up to ``upto`` into one, then delete them.

    Both the merge of trades and the choice of a part's newest version give the same with the
    folded rows, the deltas or both, so a job that stops half-way, a reader in between and a
    batch delivered again all see the same trades. No reader may hold a plan over the files
    that go; the serve job plans anew in each batch, and gold is not touched.
    """
    fold = -(upto + 1)
    old = spark.read.parquet(paths.trades).where(F.col("batch_id") <= upto)
    merged = parts.merge_trades(old, "slot").withColumn("batch_id", F.lit(fold))
    replace_partitions(merged.sortWithinPartitions("slot", "trade_date"), paths.trades, ["slot", "batch_id"], cluster=False)
    versions = spark.read.parquet(paths.parts).where(F.col("batch_id") <= upto)
    newest = parts.newest_parts(versions, _age(F.col("batch_id"))).withColumn("batch_id", F.lit(fold))
    replace_partitions(newest.sortWithinPartitions("trade_date"), paths.parts, ["batch_id"])
    for folder in [paths.parts, *pointer.subfolders(spark, paths.trades)]:
        for batch in pointer.subfolders(spark, folder):
            key, _, value = batch.rpartition("/")[2].partition("=")
            if key == "batch_id" and int(value) <= upto and int(value) != fold:
                pointer.delete(spark, batch)


def start(spark: SparkSession, events: DataFrame, paths: ServePaths, available_now: bool = True):
    """Start the serve query over a streaming DataFrame of decoded events."""
    writer = (events.writeStream
              .foreachBatch(lambda df, bid: process_batch(current(df.sparkSession, paths.base), df, bid) and None)
              .option("checkpointLocation", paths.checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
