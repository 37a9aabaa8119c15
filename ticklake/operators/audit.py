"""Audit tables (publish, backfill, corporate actions), constraint checks, download
classification and the trading calendar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.operators import cursor, parse
from ticklake.operators import dividends as dv
from ticklake.schemas import ACTION_CANCELLED, BACKFILL_CALENDAR_DAYS, STATUS_PAID


FILE = ["file_ticker", "session_date", "filename"]


def publish_audit(marked: DataFrame) -> DataFrame:
    """Per landed file: trades parsed, trades newly published, and price/time of the
    last published trade in file order (``line_no``, ties broken by the line text).

    Input: parsed good trades flagged ``is_new`` (``cursor.mark_new``), so the file is
    parsed and joined once and a single aggregation produces every figure.
    """
    keys = FILE
    new = F.col("is_new")
    last = F.max_by(F.struct("price", "traded_at"), F.when(new, F.struct("line_no", "raw_line")))
    return (marked.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(new).alias("published"),
                 last.alias("_l"))
            .select(F.col("file_ticker").alias("ticker"), "session_date", "filename", "total",
                    "published", F.col("_l.price").alias("last_price"),
                    F.col("_l.traded_at").alias("last_traded_at")))


def file_counts(marked: DataFrame) -> DataFrame:
    """Per landed file: trades parsed, newly published, and the last published line's number. Plain
    numbers, so partial aggregates go through a hash table."""
    new = F.col("is_new")
    return marked.groupBy(*FILE).agg(F.count(F.lit(1)).alias("total"), F.count_if(new).alias("published"),
                                     F.max(F.when(new, F.col("line_no"))).alias("_at"))


def publish_audit_of(marked: DataFrame, counts: DataFrame) -> DataFrame:
    """``publish_audit`` in two passes over trades that are at hand; ``counts``: ``file_counts`` of
    them, one row per file. Only the lines that may be a file's last are compared by text."""
    lasts = marked.where("is_new").join(
        counts.select(*FILE, F.col("_at").alias("line_no")), [*FILE, "line_no"]).groupBy(*FILE).agg(
        F.max_by(F.struct("price", "traded_at"), "raw_line").alias("_l"))
    return counts.join(lasts, FILE, "left").select(
        F.col("file_ticker").alias("ticker"), "session_date", "filename", "total", "published",
        F.col("_l.price").alias("last_price"), F.col("_l.traded_at").alias("last_traded_at"))


def backfill_progress(audit_rows: DataFrame, files: DataFrame) -> DataFrame:
    """Per swept session: files swept, trades parsed and published, and the number
    of sessions in the sweep (a scalar subquery)."""
    sessions = files.select(F.countDistinct("session_date")).scalar()
    return (audit_rows.groupBy("session_date")
            .agg(F.count(F.lit(1)).alias("files"),
                 F.sum("total").cast("bigint").alias("parsed"),
                 F.sum("published").cast("bigint").alias("published"))
            .withColumn("sessions_total", sessions))


def backfill_sweep(lines: DataFrame, calendar: DataFrame, before: DataFrame) -> DataFrame:
    """The landed files of the calendar's sessions, published above the cursor and then
    swept again with the moved cursor.

    One row per landed file, also without a good line: trades parsed, published (with
    cancellations, which always pass), and trades that the second sweep would publish, which
    is 0 unless the cursor failed to move.
    """
    file = ["file_ticker", "session_date", "filename"]
    swept = lines.join(calendar.select("session_date").distinct(), "session_date", "left_semi")
    trades = parse.good_rows(parse.parse_lines(swept))
    marked = cursor.mark_new(trades, before)
    moved = cursor.advance(before, cursor.updates(marked.filter("is_new").drop("is_new")))
    again = cursor.mark_new(marked.withColumnRenamed("is_new", "_first"), moved)
    counts = again.groupBy(*file).agg(
        F.count(F.lit(1)).alias("parsed"), F.count_if("_first").alias("published"),
        F.count_if(F.col("is_new") & (F.col("action") != ACTION_CANCELLED)).alias("published_again"))
    return (swept.select(*file).distinct().join(counts, file, "left")
            .fillna(0, ["parsed", "published", "published_again"])
            .withColumnRenamed("file_ticker", "ticker"))


def action_audit(cash: DataFrame, stock: DataFrame, as_of) -> DataFrame:
    """Per ticker: cash events, stock events, cash events not yet paid (full status)."""
    today = dv.market_today(as_of)
    c = cash.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("cash"),
        F.count_if(dv.status_full(F.col("last_date_prior"), F.col("payment_date"), today)
                   != STATUS_PAID).alias("pending"))
    s = stock.groupBy("ticker").agg(F.count(F.lit(1)).alias("stock"))
    return (c.join(s, "ticker", "full")
            .select("ticker", F.coalesce("cash", F.lit(0)).alias("cash"),
                    F.coalesce("stock", F.lit(0)).alias("stock"),
                    F.coalesce("pending", F.lit(0)).alias("pending")))


def _null_checks(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All NOT NULL rules of a table in one aggregate, then one row per rule."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(table).alias("table_name"), F.lit(f"not null {c}").alias("rule"), F.col(c).alias("violations"))
        for c in columns])))


def _dup_check(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    dups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return dups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations")) \
               .select(F.lit(table).alias("table_name"),
                       F.lit("duplicate key (" + ",".join(keys) + ")").alias("rule"), "violations")


def constraint_violations(tables: dict[str, DataFrame], not_null: dict[str, list[str]],
                          keys: dict[str, list[str]]) -> DataFrame:
    """K7: one row per (table, rule) with its violation count (zero included)."""
    parts = []
    for name, df in tables.items():
        if not_null.get(name):
            parts.append(_null_checks(df, name, not_null[name]))
        if name in keys:
            parts.append(_dup_check(df, name, keys[name]))
    return reduce(DataFrame.unionByName, parts)


def classify_downloads(manifest: DataFrame) -> DataFrame:
    """404 -> unavailable; other non-200 -> fetch_error; 200 without a
    content-disposition or with an empty body -> unavailable (expired); else ok."""
    status = F.col("http_status")
    no_body = F.coalesce(F.col("content_length"), F.lit(0)) == 0
    no_header = ~F.coalesce(F.col("has_content_disposition"), F.lit(False))
    klass = (F.when(status == 404, F.lit("unavailable"))
              .when(status != 200, F.lit("fetch_error"))
              .when(no_body | no_header, F.lit("unavailable"))
              .otherwise(F.lit("ok")))
    reason = (F.when(status == 404, F.lit("not published (404)"))
               .when(status != 200, F.concat(F.lit("unexpected HTTP "), status.cast("string")))
               .when(no_body | no_header, F.lit("empty body / missing content-disposition"))
               .otherwise(F.lit(None).cast("string")))
    return manifest.select("ticker", "session_date", "http_status", klass.alias("class"),
                           reason.alias("reason"))


def trading_calendar(run_dates: DataFrame, days: int = BACKFILL_CALENDAR_DAYS) -> DataFrame:
    """for each run date, the weekdays among the previous ``days`` calendar days
    (today excluded), oldest first. Bounded fan-out: ``days`` rows per run date."""
    d = F.col("run_date")
    return (run_dates.select("run_date", F.explode(F.sequence(F.date_sub(d, days), F.date_sub(d, 1)))
                             .alias("session_date"))
            .filter(F.weekday("session_date") < 5).orderBy("run_date", "session_date"))
