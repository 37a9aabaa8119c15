"""Serving-side reads: ticker documents, unknown-ticker answers, health, change digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.money import money_text
from ticklake.functions.text import etag, normalize_ticker
from ticklake.functions.timefmt import age_seconds, iso_instant, market_window_open, utc_literal
from ticklake.operators import dividends as dv
from ticklake.operators.views import latest_session
from ticklake.schemas import (
    CHAIN_NOTE, CORPORATE_ACTIONS_MAX_AGE_SECONDS, TRADES_MAX_AGE_SECONDS, UNKNOWN_TICKER_ERROR,
)

PENDING_ITEM_COLUMNS = ["type", "status", "gross_per_share", "net_per_share", "tax_note",
                        "approved_on", "buy_by", "payment_date", "payment_tbd",
                        "yield_on_last_price"]


def session_item(summary_row_cols: DataFrame) -> list[Column]:
    """Session as public text (money nullable, OHLC NULL before the first regular
    trade), prefixed ``session_``."""
    return [
        F.col("trade_date").cast("string").alias("session_date"),
        money_text(F.col("open")).alias("session_open"),
        money_text(F.col("high")).alias("session_high"),
        money_text(F.col("low")).alias("session_low"),
        money_text(F.col("close")).alias("session_close"),
        F.col("quantity").alias("session_quantity"),
        money_text(F.col("financial_volume")).alias("session_financial_volume"),
        F.col("trades").alias("session_trades"),
    ]


def ticker_documents(last_price: DataFrame, summary: DataFrame, cash: DataFrame, as_of) -> DataFrame:
    """Per ticker, price (required) + latest session (optional) + pending dividends
    (possibly none), for every priced ticker at once.

    The pending list is not collected into one value per ticker: a ticker's document is
    its header row repeated per pending item (one row with NULL item columns when there is
    none). A server assembles one document from its ticker's rows; nothing here grows a
    single task with the size of a ticker's history.
    """
    header = last_price.select("ticker", money_text(F.col("price")).alias("last_price"),
                               iso_instant(F.col("traded_at")).alias("price_as_of"))
    sess = latest_session(summary)
    sess = sess.select("ticker", *session_item(sess))
    items = dv.pending(cash, last_price, as_of, ordered=False).select("ticker", *PENDING_ITEM_COLUMNS)
    header = header.join(sess, "ticker", "left")
    # An inner join keeps the large side splittable (and the header broadcastable where its
    # measured size allows); headers without an item are added from a narrow second pass.
    full = header.join(items, "ticker")
    alone = header.join(items.select("ticker").distinct(), "ticker", "left_anti")
    return full.unionByName(alone, allowMissingColumns=True)


def document_etags(docs: DataFrame) -> DataFrame:
    """F24 re-aimed: a content digest per ticker document, independent of row order.

    Each pending item is hashed (SHA-256, first 60 bits) and the hashes are summed as an
    exact decimal; the header text, item count and that sum are hashed again and quoted.
    """
    header_cols = ["last_price", "price_as_of", "session_date", "session_open", "session_high",
                   "session_low", "session_close", "session_quantity",
                   "session_financial_volume", "session_trades"]
    text = lambda cols: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    item_text = F.concat_ws("|", text([c for c in PENDING_ITEM_COLUMNS if c != "yield_on_last_price"]),
                            F.round(F.col("yield_on_last_price") * F.lit(1000000.0)).cast("bigint")
                             .cast("string"))
    item_hash = F.conv(F.substring(F.sha2(item_text, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    has_item = F.col("type").isNotNull()
    per_ticker = docs.groupBy("ticker").agg(
        F.first(text(header_cols)).alias("_header"),  # identical on every row of a ticker
        F.count_if(has_item).alias("pending_count"),
        F.coalesce(F.sum(F.when(has_item, item_hash)), F.lit(0).cast("decimal(38,0)"))
         .cast("decimal(38,0)").alias("_digest"))
    body = F.concat_ws("|", F.col("ticker"), F.col("_header"),
                       F.col("pending_count").cast("string"), F.col("_digest").cast("string"))
    return per_ticker.select("ticker", "pending_count", etag(body).alias("etag"))


def changed_documents(before: DataFrame, now: DataFrame) -> DataFrame:
    """Which ticker documents changed between two snapshots (the data meaning of a
    304-vs-200 answer)."""
    b = before.select("ticker", F.col("etag").alias("etag_before"))
    n = now.select("ticker", F.col("etag").alias("etag_now"))
    return (b.join(n, "ticker", "full")
            .select("ticker", "etag_before", "etag_now",
                    (~F.col("etag_before").eqNullSafe(F.col("etag_now"))).alias("changed")))


def unknown_tickers(requests: DataFrame, last_price: DataFrame) -> DataFrame:
    """Requested tickers (trimmed, upper-cased) with no price row, each answered with
    the error text and the sorted list of known tickers. The list is one scalar subquery
    over ``last_price`` (bounded by the number of listed instruments)."""
    known = last_price.select(F.to_json(F.sort_array(F.collect_list("ticker")))).scalar()
    asked = requests.select(normalize_ticker(F.col("requested")).alias("ticker")).distinct()
    missing = asked.join(last_price.select("ticker"), "ticker", "left_anti")
    return missing.select(
        F.col("ticker").alias("requested"),
        F.replace(F.lit(UNKNOWN_TICKER_ERROR), F.lit("{}"), F.col("ticker")).alias("error"),
        known.alias("available_tickers"))


def health(spark: SparkSession, last_price: DataFrame, cash: DataFrame, summary: DataFrame,
           as_of) -> DataFrame:
    """A10 + F15/F16: one freshness row. The four inputs are scalar subqueries (J6);
    thresholds compare full-precision ages, reported ages are whole seconds."""
    now = utc_literal(as_of)
    latest_trade = last_price.select(F.max("traded_at")).scalar()
    synced = cash.select(F.max("synced_at")).scalar()
    latest_session_date = summary.select(F.max("trade_date")).scalar()
    sessions = summary.select(F.count(F.lit(1))).scalar()
    window = market_window_open(now)
    trade_age_us = F.timestamp_diff("MICROSECOND", latest_trade, now)
    sync_age_us = F.timestamp_diff("MICROSECOND", synced, now)
    trades_fresh = latest_trade.isNotNull() & (
        ~window | (trade_age_us <= F.lit(TRADES_MAX_AGE_SECONDS * 1000000)))
    actions_fresh = synced.isNotNull() & (
        sync_age_us <= F.lit(CORPORATE_ACTIONS_MAX_AGE_SECONDS * 1000000))
    row = spark.range(1).select(
        F.when(trades_fresh & actions_fresh, F.lit("ok")).otherwise(F.lit("degraded")).alias("status"),
        iso_instant(now).alias("checked_at"),
        window.alias("market_window_open"),
        iso_instant(latest_trade).alias("trades_latest_traded_at"),
        age_seconds(now, latest_trade).alias("trades_age_seconds"),
        F.coalesce(trades_fresh, F.lit(False)).alias("trades_fresh"),
        F.lit(CHAIN_NOTE).alias("trades_note"),
        iso_instant(synced).alias("actions_last_synced_at"),
        age_seconds(now, synced).alias("actions_age_seconds"),
        F.coalesce(actions_fresh, F.lit(False)).alias("actions_fresh"),
        latest_session_date.cast("string").alias("sessions_latest"),
        sessions.alias("sessions_count"),
    )
    return row
