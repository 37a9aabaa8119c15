"""K6: mirror corporate-action reference data by full replacement per ticker.

A sync writes its rows of ``cash_dividends`` and ``stock_dividends`` into folders of its own
(``sync=<id>``), then a manifest (ticker, sync) that names the sync each ticker was last
replaced by, and then replaces one pointer to the manifest. Readers resolve the pointer once
and so see both tables of one moment; a sync that stops anywhere before the pointer leaves
them the pair they had, and running it again writes a new one. A ticker whose set is now empty
stands in the manifest without rows; a ticker whose fetch failed keeps its manifest row and
with it its last known rows. A sync writes its own rows and one manifest row per ticker.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.timefmt import utc_literal
from ticklake.operators import dividends as dv
from ticklake.schemas import CASH_DIVIDENDS_SCHEMA, STOCK_DIVIDENDS_SCHEMA
from ticklake.sinks import pointer

TABLES = {"cash_dividends": CASH_DIVIDENDS_SCHEMA, "stock_dividends": STOCK_DIVIDENDS_SCHEMA}


def synced_tickers(unwrapped: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Tickers whose supplement decoded (fetch succeeded), via the issuer lookup."""
    ok = unwrapped.filter(F.col("doc_error").isNull()).select("issuing_company").distinct()
    return ok.join(dv.issuer_tickers(watchlist), "issuing_company").select("ticker")


def newest_documents(docs: DataFrame, path: str) -> DataFrame:
    """The newest document (highest ``doc_id``) of each issuer that decodes. All are decoded once,
    for their ids alone, which are written to ``path``: the landed documents then meet a table
    of known size, one row per issuer, and no decoded document is kept."""
    newest = (dv.unwrap_supplement(docs).filter(F.col("doc_error").isNull()).groupBy("issuing_company")
              .agg(F.max("doc_id").alias("doc_id")))
    newest.write.parquet(path)
    newest = docs.sparkSession.read.schema(newest.schema).parquet(path)
    return docs.join(newest, ["issuing_company", "doc_id"], "left_semi")


def _pointer(base: str) -> str:
    return f"{base}/current.json"


def _manifest(spark: SparkSession, base: str) -> DataFrame:
    """(ticker, sync) of the published moment; no rows before the first sync."""
    now = pointer.resolve(spark, _pointer(base))
    if not now:
        return spark.createDataFrame([], "ticker string, sync string")
    return spark.read.schema("ticker string, sync string").parquet(f"{base}/manifest/{now['manifest']}")


def sync(docs: DataFrame, watchlist: DataFrame, base: str, synced_at) -> None:
    """Decode, filter and replace both tables for every successfully fetched ticker; of
    several documents of an issuer the newest that decodes counts."""
    spark = docs.sparkSession
    this = uuid.uuid4().hex
    newest = f"{base}/newest/{this}"
    unwrapped = dv.unwrap_supplement(newest_documents(docs, newest)).persist()
    try:
        stamp = utc_literal(synced_at).alias("synced_at")
        cash = dv.for_tracked(dv.parse_cash_rows(unwrapped), watchlist, dv.CASH_COLUMNS)
        stock = dv.for_tracked(dv.parse_stock_rows(unwrapped), watchlist, dv.STOCK_COLUMNS)
        for name, rows in (("cash_dividends", cash), ("stock_dividends", stock)):
            rows.select("*", stamp).write.parquet(f"{base}/{name}/sync={this}")
        tickers = synced_tickers(unwrapped, watchlist).distinct()
        kept = _manifest(spark, base).join(tickers, "ticker", "left_anti")
        kept.unionByName(tickers.withColumn("sync", F.lit(this))).write.parquet(f"{base}/manifest/{this}")
        pointer.publish(spark, _pointer(base), {"manifest": this})
    finally:
        unwrapped.unpersist()
        pointer.delete(spark, newest)


def read(spark: SparkSession, base: str, live_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """(cash, stock) dividends of the published moment, both through one resolve of the pointer.
    With ``live_only`` False, tickers without rows appear as one marker row a table."""
    manifest = _manifest(spark, base)
    out = []
    for name, schema in TABLES.items():
        if pointer.subfolders(spark, f"{base}/{name}"):
            typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
            stored = spark.read.schema(f"{typed}, sync string").parquet(f"{base}/{name}")
        else:
            stored = spark.createDataFrame([], schema).withColumn("sync", F.lit(""))
        rows = stored.join(manifest, ["ticker", "sync"], "left_semi").drop("sync")
        if not live_only:
            none = manifest.join(rows.select("ticker").distinct(), "ticker", "left_anti").select(
                "ticker", F.lit(True).alias("is_marker"))
            rows = rows.withColumn("is_marker", F.lit(False)).unionByName(none, allowMissingColumns=True)
        out.append(rows)
    return tuple(out)


def vacuum(spark: SparkSession, base: str) -> None:
    """Delete the folders of syncs that the published manifest no longer names. Readers that
    resolved an older pointer must be done."""
    now = pointer.resolve(spark, _pointer(base))
    if not now:
        return
    used = {r.sync for r in _manifest(spark, base).select("sync").distinct().collect()}  # syncs, not rows
    for name in TABLES:
        for folder in pointer.subfolders(spark, f"{base}/{name}"):
            if folder.rpartition("sync=")[2] not in used:
                pointer.delete(spark, folder)
    for folder in pointer.subfolders(spark, f"{base}/manifest"):
        if not folder.endswith(now["manifest"]):
            pointer.delete(spark, folder)
