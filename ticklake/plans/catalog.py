"""The named query catalogue: each entry takes (spark, sf_dir) and returns a DataFrame.

Queries read the driver tables (through ``ticklake.sources``) and compose operators;
nothing is collected to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.operators import audit, cursor, dividends, intervals, parse, radar, serving, views
from ticklake.plans.oracle import AS_OF, FIRST_SYNC, PREV_AS_OF, SYNCED_AT
from ticklake.schemas import KEYS, NOT_NULL, SOURCE_INTRADAY, TRADE_COLUMNS, TRADE_EVENT_COLUMNS
from ticklake.session import shared_dir
from ticklake.sinks import contracts, corporate_actions, cursor_log, pointer, snapshots
from ticklake.sinks.keyed import replace_partitions
from ticklake.sources import archives, derived, events
from ticklake.sources.archives import ARCHIVE_SCHEMA, land_archives
from ticklake.sources.events import read_event_log
from ticklake.sources.tables import gold
from ticklake.streaming import counts, ingest, serve
from ticklake.streaming.replay import run_counts_over_drops, run_cursor_over_drops, run_serve_over_drops

Query = Callable[[SparkSession, str], DataFrame]


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.trades_clean(derived.trade_events(spark, sf_dir))


def q_session_event_counts(spark, sf_dir):
    return views.session_event_counts(derived.trade_events(spark, sf_dir))


def q_trades_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


def q_last_price(spark, sf_dir):
    return views.last_price(_clean(spark, sf_dir))


def q_session_summary(spark, sf_dir):
    return views.session_summary(_clean(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "session_event_counts": q_session_event_counts,
    "trades_clean": q_trades_clean,
    "last_price": q_last_price,
    "session_summary": q_session_summary,
}


def _parsed(spark, sf_dir):
    return parse.parse_lines(derived.trade_lines(spark, sf_dir))


def q_parse_trade_lines(spark, sf_dir):
    return parse.good_rows(_parsed(spark, sf_dir)).select("filename", *TRADE_COLUMNS)


def q_dead_letters(spark, sf_dir):
    return parse.dead_letters(parse.bad_rows(_parsed(spark, sf_dir)))


def q_trade_events_json(spark, sf_dir):
    return parse.trade_event_json(parse.good_rows(_parsed(spark, sf_dir)), "eod_file")


def q_decode_events(spark, sf_dir):
    return events.decode_values(derived.raw_event_values(spark, sf_dir), "k BIGINT") \
        .select("event_id", "k")


QUERIES.update({
    "parse_trade_lines": q_parse_trade_lines,
    "dead_letters": q_dead_letters,
    "trade_events_json": q_trade_events_json,
    "decode_events": q_decode_events,
})


def _good_trades(spark, sf_dir):
    return parse.good_rows(parse.parse_lines(derived.trade_lines(spark, sf_dir)))


def _cursor0(spark, sf_dir):
    """Cursor left by an earlier poll that published line numbers 1-3 of every order."""
    first = derived.trade_events(spark, sf_dir).filter(F.col("trade_id") % 10 <= 3)
    return cursor.updates(first)


def q_cursor_filter(spark, sf_dir):
    return cursor.filter_new(_good_trades(spark, sf_dir), _cursor0(spark, sf_dir)) \
        .select("filename", *TRADE_COLUMNS)


def q_cursor_updates(spark, sf_dir):
    published = cursor.filter_new(_good_trades(spark, sf_dir), _cursor0(spark, sf_dir))
    return cursor.updates(published)


def q_cursor_fold(spark, sf_dir):
    return cursor.fold_log(derived.cursor_log(spark, sf_dir))


def q_replay_counts(spark, sf_dir):
    """Apply the cursor twice to the same files. The second pass publishes no new
    trade, only the cancellations (which always pass and are deduplicated downstream)."""
    trades = _good_trades(spark, sf_dir)
    c0 = _cursor0(spark, sf_dir)
    first = cursor.filter_new(trades, c0)
    c1 = cursor.advance(c0, cursor.updates(first))
    second = cursor.filter_new(trades, c1)

    def counts(df, prefix):
        return df.groupBy("ticker", "trade_date").agg(
            F.count_if(F.col("action") != 2).alias(f"{prefix}_new"),
            F.count_if(F.col("action") == 2).alias(f"{prefix}_cancels"))

    return (counts(first, "first").join(counts(second, "replay"), ["ticker", "trade_date"], "full")
            .select("ticker", "trade_date",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in
                      ("first_new", "first_cancels", "replay_new", "replay_cancels")]))


QUERIES.update({
    "cursor_filter": q_cursor_filter,
    "cursor_updates": q_cursor_updates,
    "cursor_fold": q_cursor_fold,
    "replay_counts": q_replay_counts,
})


def _unwrapped(spark, sf_dir):
    return dividends.unwrap_supplement(derived.supplement_documents(spark, sf_dir))


def q_parse_cash_dividends(spark, sf_dir):
    rows = dividends.parse_cash_rows(_unwrapped(spark, sf_dir))
    return dividends.for_tracked(rows, derived.tracked_tickers(spark, sf_dir), dividends.CASH_COLUMNS)


def q_parse_stock_dividends(spark, sf_dir):
    rows = dividends.parse_stock_rows(_unwrapped(spark, sf_dir))
    return dividends.for_tracked(rows, derived.tracked_tickers(spark, sf_dir), dividends.STOCK_COLUMNS)


def q_supplement_errors(spark, sf_dir):
    return dividends.supplement_errors(_unwrapped(spark, sf_dir)).select("doc_id", "row_no", "error")


def _cash(spark, sf_dir):
    return derived.cash_dividends(spark, sf_dir, SYNCED_AT)


def _last_price(spark, sf_dir):
    return views.last_price(_clean(spark, sf_dir))


def q_dividend_status(spark, sf_dir):
    return dividends.statuses(_cash(spark, sf_dir), AS_OF)


def q_pending_dividends(spark, sf_dir):
    return dividends.pending(_cash(spark, sf_dir), _last_price(spark, sf_dir), AS_OF)


def q_pending_dividends_one(spark, sf_dir):
    return dividends.pending(_cash(spark, sf_dir), _last_price(spark, sf_dir), AS_OF, ticker=" tk04 ")


QUERIES.update({
    "parse_cash_dividends": q_parse_cash_dividends,
    "parse_stock_dividends": q_parse_stock_dividends,
    "supplement_errors": q_supplement_errors,
    "dividend_status": q_dividend_status,
    "pending_dividends": q_pending_dividends,
    "pending_dividends_one": q_pending_dividends_one,
})


def _summary(spark, sf_dir):
    return views.session_summary(_clean(spark, sf_dir))


def _last_price_cut(spark, sf_dir):
    """Last price (one row per ticker) cut from its lineage, for queries that read it more
    than once (a scalar subquery plus the main plan) and need nothing else of the trades."""
    shared_dir(spark, "lineage")  # makes sure a checkpoint folder is configured
    return _last_price(spark, sf_dir).checkpoint(eager=True)


def _rollup(spark, sf_dir):
    """Per-session rollup (summary + latest trade) computed once and cut from its lineage
    in the shared checkpoint folder: queries that need both the last price and the
    sessions read it instead of deduplicating the trades once per branch."""
    shared_dir(spark, "lineage")  # makes sure a checkpoint folder is configured
    return views.session_rollup(_clean(spark, sf_dir)).checkpoint(eager=True)


def q_latest_session(spark, sf_dir):
    return views.latest_session(_summary(spark, sf_dir))


def _documents(spark, sf_dir, as_of, rollup=None):
    r = rollup if rollup is not None else _rollup(spark, sf_dir)
    return serving.ticker_documents(views.last_price_of(r), views.summary_of(r),
                                    _cash(spark, sf_dir), as_of)


def q_ticker_documents(spark, sf_dir):
    return _documents(spark, sf_dir, AS_OF)


def q_changed_documents(spark, sf_dir):
    r = _rollup(spark, sf_dir)
    before = serving.document_etags(_documents(spark, sf_dir, PREV_AS_OF, r))
    now = serving.document_etags(_documents(spark, sf_dir, AS_OF, r))
    return serving.changed_documents(before, now)


def q_unknown_tickers(spark, sf_dir):
    lp = _last_price_cut(spark, sf_dir)  # read twice: anti join + known list
    return serving.unknown_tickers(derived.ticker_requests(spark, sf_dir), lp)


def q_health_report(spark, sf_dir):
    r = _rollup(spark, sf_dir)
    return serving.health(spark, views.last_price_of(r), _cash(spark, sf_dir),
                          views.summary_of(r), AS_OF)


def q_dividend_radar(spark, sf_dir):
    lp = _last_price_cut(spark, sf_dir)  # read twice: rows + best-yield subquery
    return radar.radar(_cash(spark, sf_dir), lp, AS_OF)


def q_radar_headline(spark, sf_dir):
    cash, lp = _cash(spark, sf_dir), _last_price_cut(spark, sf_dir)
    return radar.headline(radar.radar(cash, lp, AS_OF), cash, lp, AS_OF)


def q_radar_events(spark, sf_dir):
    return radar.event_rows(_cash(spark, sf_dir), _last_price(spark, sf_dir), AS_OF)


def q_day_change(spark, sf_dir):
    return radar.day_change(views.latest_session(_summary(spark, sf_dir)))


def q_range_position(spark, sf_dir):
    r = _rollup(spark, sf_dir)
    return radar.range_position(views.latest_session(views.summary_of(r)), views.last_price_of(r))


def q_trading_calendar(spark, sf_dir):
    runs = derived.trade_events(spark, sf_dir).select(
        F.col("reference_date").alias("run_date")).distinct()
    return audit.trading_calendar(runs)


def _marked(spark, sf_dir):
    return cursor.mark_new(_good_trades(spark, sf_dir), _cursor0(spark, sf_dir))


def q_publish_audit(spark, sf_dir):
    return audit.publish_audit(_marked(spark, sf_dir))


def q_backfill_progress(spark, sf_dir):
    rows = audit.publish_audit(_marked(spark, sf_dir))
    return audit.backfill_progress(rows, derived.trade_lines(spark, sf_dir))


def _stock(spark, sf_dir):
    return derived.stock_dividends(spark, sf_dir, SYNCED_AT)


def q_action_audit(spark, sf_dir):
    return audit.action_audit(_cash(spark, sf_dir), _stock(spark, sf_dir), AS_OF)


def q_constraint_violations(spark, sf_dir):
    r = _rollup(spark, sf_dir)
    tables = {
        "last_price": views.last_price_of(r),
        "session_summary": views.summary_of(r),
        "cash_dividends": _cash(spark, sf_dir),
        "stock_dividends": _stock(spark, sf_dir),
        "tracked_tickers": derived.tracked_tickers(spark, sf_dir),
    }
    not_null, keys = NOT_NULL, KEYS
    return audit.constraint_violations(tables, not_null, keys)


def q_download_classes(spark, sf_dir):
    return audit.classify_downloads(derived.download_manifest(derived.trade_lines(spark, sf_dir)))


QUERIES.update({
    "latest_session": q_latest_session,
    "ticker_documents": q_ticker_documents,
    "changed_documents": q_changed_documents,
    "unknown_tickers": q_unknown_tickers,
    "health_report": q_health_report,
    "dividend_radar": q_dividend_radar,
    "radar_headline": q_radar_headline,
    "radar_events": q_radar_events,
    "day_change": q_day_change,
    "range_position": q_range_position,
    "trading_calendar": q_trading_calendar,
    "publish_audit": q_publish_audit,
    "backfill_progress": q_backfill_progress,
    "action_audit": q_action_audit,
    "constraint_violations": q_constraint_violations,
    "download_classes": q_download_classes,
})


_SUMMARY_COLUMNS = ["ticker", "trade_date", "open", "high", "low", "close", "quantity",
                    "financial_volume", "trades"]


def _delivered(spark, sf_dir):
    """The trade events with the drop they arrive in: re-deliveries of a trade differ in
    quantity and so come in other drops, and the last drop also cancels line 1 of every
    third order."""
    trades = derived.trade_events(spark, sf_dir).withColumn(
        "_drop", F.coalesce(F.col("quantity") % 4, F.lit(0)).cast("int"))
    late = trades.filter(F.col("trade_id") % 30 == 1).withColumns({"action": F.lit(2), "_drop": F.lit(3)})
    return trades.unionByName(late)


def _stream_paths(spark, sf_dir):
    """The events come in 4 drops, each served by an availableNow run of the
    streaming job; gold must equal the batch views."""
    return run_serve_over_drops(spark, _delivered(spark, sf_dir), F.col("_drop"), 4)


def q_stream_session_summary(spark, sf_dir):
    return gold(spark, _stream_paths(spark, sf_dir).summary).select(*_SUMMARY_COLUMNS)


def q_rebuild_gold(spark, sf_dir):
    """All gold tables from bronze alone, where no gold exists."""
    paths = serve.ServePaths(shared_dir(spark, f"rebuild-{uuid.uuid4().hex[:12]}"))
    landed = _delivered(spark, sf_dir).withColumnRenamed("_drop", "batch_id")
    replace_partitions(landed, paths.bronze, ["trade_date", "batch_id"], cluster=False)
    paths = serve.rebuild(spark, paths)
    return gold(spark, paths.summary).select(*_SUMMARY_COLUMNS)


def q_stream_last_price(spark, sf_dir):
    paths = _stream_paths(spark, sf_dir)
    return gold(spark, paths.last_price).select("ticker", "price", "traded_at")


QUERIES.update({
    "stream_session_summary": q_stream_session_summary,
    "stream_last_price": q_stream_last_price,
    "rebuild_gold": q_rebuild_gold,
})


def q_backfill_sweep(spark, sf_dir):
    """The landed files of the calendar's sessions, published twice."""
    runs = derived.trade_events(spark, sf_dir).select(F.col("reference_date").alias("run_date")).distinct()
    return audit.backfill_sweep(derived.trade_lines(spark, sf_dir), audit.trading_calendar(runs),
                                _cursor0(spark, sf_dir))


def q_corporate_actions_sync(spark, sf_dir):
    """K6: the supplement documents come in two rounds; in the second the fetches of two
    issuers fail, so their tickers keep what the first round stored."""
    docs = derived.supplement_documents(spark, sf_dir).withColumn("_round", F.floor(F.col("doc_id") / 2) % 2)
    failed = F.col("issuing_company").isin("CO04", "CO14")
    watchlist = derived.tracked_tickers(spark, sf_dir)
    base = shared_dir(spark, f"actions-{uuid.uuid4().hex[:12]}")
    first = docs.filter("_round = 0").drop("_round")
    second = docs.filter("_round = 1").drop("_round").withColumn(
        "body", F.when(failed, F.lit("")).otherwise(F.col("body")))
    corporate_actions.sync(first, watchlist, base, FIRST_SYNC)
    corporate_actions.sync(second, watchlist, base, SYNCED_AT)

    cash, stock = corporate_actions.read(spark, base, live_only=False)

    def stored(rows, name, amount):
        return rows.select(
            F.lit(name).alias("table_name"), "ticker", "isin", "label", F.col(amount).alias("amount"),
            "approved_on", "synced_at", "is_marker")

    return stored(cash, "cash", "rate").unionByName(stored(stock, "stock", "factor"))


QUERIES.update({
    "backfill_sweep": q_backfill_sweep,
    "corporate_actions_sync": q_corporate_actions_sync,
})


def q_stream_cursor(spark, sf_dir):
    """T3 streaming: an early snapshot (line numbers 1-3 of every order) then the full file, both
    of lines that are parsed once; the cursor is a log with one record per session and batch."""
    parsed = shared_dir(spark, f"trades-{uuid.uuid4().hex[:12]}") + "/parsed"
    _good_trades(spark, sf_dir).select(*TRADE_COLUMNS).write.parquet(parsed)
    good = spark.read.parquet(parsed)
    early = good.filter(F.col("trade_id") % 10 <= 3).withColumn("_d", F.lit(0))
    full = good.withColumn("_d", F.lit(1))
    both = early.unionByName(full)
    out = run_cursor_over_drops(spark, both, F.col("_d"), 2)
    return spark.read.parquet(out).select("drop", *TRADE_COLUMNS)


QUERIES["stream_cursor"] = q_stream_cursor


def q_ingest_events(spark, sf_dir):
    """S1 + K1-K3 + T3/T4: the lines land as zip archives, the ingest stream runs once
    (empty cursor: every good trade is published) and the event log is decoded back."""
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:12]}"))
    land_archives(derived.trade_lines(spark, sf_dir), paths.landing).count()
    ingest.start(spark, paths, ARCHIVE_SCHEMA).awaitTermination()
    return read_event_log(spark, paths.event_log).select(*TRADE_EVENT_COLUMNS)


QUERIES["ingest_events"] = q_ingest_events


def q_stream_event_counts(spark, sf_dir):
    """A1 streaming: native stateful count (update mode) over 4 drops of the event log, in
    each of which some events have no ticker."""
    known = F.when(F.col("trade_id") % 97 != 5, F.col("ticker"))
    out = run_counts_over_drops(spark, _delivered(spark, sf_dir).withColumn("ticker", known), F.col("_drop"), 4)
    return gold(spark, out).select("ticker", "trade_date", "events")


QUERIES["stream_event_counts"] = q_stream_event_counts


def q_recover_event_counts(spark, sf_dir):
    """A1 after a loss: every third day's partition of the counts is deleted and restored from
    the streaming state in the checkpoint."""
    run_dir = shared_dir(spark, f"recover-{uuid.uuid4().hex[:12]}")
    out = run_counts_over_drops(spark, _delivered(spark, sf_dir), F.col("_drop"), 4, run_dir)
    for folder in sorted(pointer.subfolders(spark, out))[::3]:
        pointer.delete(spark, folder)
    counts.heal(spark, out, f"{run_dir}/_checkpoints/counts")
    return gold(spark, out).select("ticker", "trade_date", "events")


def q_rebuild_vanished_day(spark, sf_dir):
    """T7 with teeth: gold is served, then the newest day of bronze vanishes and gold is rebuilt.
    Some trades have no time, so sessions whose latest trade is incomplete are violations.
    One row per session of the summary, per last price and per violation."""
    timed = F.when(F.col("trade_id") % 211 != 7, F.col("traded_at"))
    landed = _delivered(spark, sf_dir).withColumn("traded_at", timed)
    paths = serve.ServePaths(shared_dir(spark, f"vanish-{uuid.uuid4().hex[:12]}"))
    serve.process_batch(paths, landed.where("_drop < 2").drop("_drop"), 0)
    serve.process_batch(paths, landed.where("_drop >= 2").drop("_drop"), 1)
    serve.compact(spark, paths, 1)
    pointer.delete(spark, max(pointer.subfolders(spark, paths.bronze)))
    serve.rebuild(spark, paths)
    now = serve.current(spark, paths.base)

    def rows(name, df, price, time):
        return df.select(F.lit(name).alias("table_name"), "ticker", "trade_date", price.alias("price"),
                         time.cast("timestamp_ntz").alias("traded_at"))

    none = F.lit(None)
    return (rows("session_summary", gold(spark, now.summary), F.col("close"), none)
            .unionByName(rows("last_price", gold(spark, now.last_price).withColumn("trade_date", none.cast("date")),
                              F.col("price"), F.col("traded_at")))
            .unionByName(rows("violations", gold(spark, now.violations), F.col("price"), F.col("traded_at"))))


def q_cursor_compacted(spark, sf_dir):
    """The cursor log arrives in four batches and is folded after each; what base and tail
    give in the end is the fold of the whole log."""
    log = derived.cursor_log(spark, sf_dir)
    end = log.select(F.max("offset") + 1).scalar()
    tagged = log.withColumn("_batch", F.floor(F.col("offset") * 4 / end).cast("int"))
    kept = cursor_log.CursorLog(f"{shared_dir(spark, f'cursor-{uuid.uuid4().hex[:12]}')}/log")
    for k in range(4):
        kept.append(tagged.where(F.col("_batch") == k), k)
        kept.compact(spark)
    return cursor.fold_log(kept.records(spark))


QUERIES.update({
    "recover_event_counts": q_recover_event_counts,
    "rebuild_vanished_day": q_rebuild_vanished_day,
    "cursor_compacted": q_cursor_compacted,
})


def q_text_line_scan(spark, sf_dir):
    """S3: the trade lines land as plain text files, one per ticker and session, and are read back
    with their number in the file."""
    root = shared_dir(spark, f"text-{uuid.uuid4().hex[:12]}") + "/lines"
    lines = derived.trade_lines(spark, sf_dir).select(
        F.col("file_ticker").alias("ticker"), "session_date", "line_no", F.col("raw_line").alias("value"))
    header = lines.select("ticker", "session_date").distinct().select(
        "ticker", "session_date", F.lit(-1).cast("long").alias("line_no"), F.lit("DataReferencia;CodigoInstrumento").alias("value"))
    order = ["ticker", "session_date", "line_no", "value"]
    files = lines.unionByName(header).repartition("ticker", "session_date").sortWithinPartitions(*order)
    files.drop("line_no").write.partitionBy("ticker", "session_date").text(root)
    return archives.read_line_files(spark, root).select("file_ticker", "session_date", "line_no", "raw_line")


def q_late_ids(spark, sf_dir):
    """Line numbers 1-3 of every order were published; what the full files bring below the
    cursor and was never published, as intervals per session."""
    first = derived.trade_events(spark, sf_dir).filter((F.col("trade_id") % 10 <= 3) & (F.col("action") != 2))
    marked = cursor.mark_new(_good_trades(spark, sf_dir), cursor.updates(first))
    return intervals.merged(intervals.islands(intervals.late(marked, intervals.islands(first))))


def q_document_changes(spark, sf_dir):
    """the documents' digests are stored in three versions; some tickers are not served in the
    first, others no longer in the third. The feed of each version."""
    r = _rollup(spark, sf_dir)
    base = shared_dir(spark, f"digests-{uuid.uuid4().hex[:12]}")
    feeds = []
    for as_of, absent in ((PREV_AS_OF, "TK03"), (AS_OF, ""), (AS_OF, "TK11")):
        docs = serving.document_etags(_documents(spark, sf_dir, as_of, r)).where(F.col("ticker") != absent)
        version = snapshots.store(docs, base)
        feeds.append(snapshots.changes(spark, base, version).select(F.lit(version).alias("version"), F.col("key").alias("ticker"),
                                                                   "change", "digest_before", "digest_now"))
    return reduce(DataFrame.unionByName, feeds)


def q_contract_violations(spark, sf_dir):
    """K7 on write: cash dividends with missing fields, wrong rates and repeated keys are checked as
    they are written; violations per rule, and what the quarantine and the good rows hold."""
    cash = _cash(spark, sf_dir)
    faulty = cash.withColumns({
        "label": F.when(F.col("approved_on").cast("string").endswith("7"), None).otherwise(F.col("label")),
        "related_to": F.when(F.month("approved_on") == 2, None).otherwise(F.col("related_to")),
        "rate": F.when(F.dayofmonth("approved_on") == 13, -F.col("rate")).otherwise(F.col("rate"))})
    path = shared_dir(spark, f"contract-{uuid.uuid4().hex[:12]}") + "/cash_dividends"
    broken = contracts.write(faulty.drop("synced_at"), path, ["ticker", "label", "related_to"], {
        "rate above 0": F.col("rate") > 0, "last day after approval": F.col("last_date_prior") > F.col("approved_on")})
    found = spark.createDataFrame(sorted(broken.items()), "rule string, violations long")
    keys = ["ticker", "approved_on"]
    repeated = contracts.repeated_keys(spark, path, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    total = contracts.quarantine(spark, path).agg(F.count(F.lit(1)).alias("violations"))
    good = contracts.read(spark, path).agg(F.count(F.lit(1)).alias("violations"))
    return (found.unionByName(repeated.select(F.lit("duplicate key (ticker,approved_on)").alias("rule"), "violations"))
            .unionByName(total.select(F.lit("quarantined").alias("rule"), "violations"))
            .unionByName(good.select(F.lit("kept").alias("rule"), "violations")))


QUERIES.update({
    "text_line_scan": q_text_line_scan,
    "late_ids": q_late_ids,
    "document_changes": q_document_changes,
    "contract_violations": q_contract_violations,
})


def _backfilled(spark, sf_dir):
    """T8 through ingest: snapshots with line numbers 1-3 of every order are polled, then the
    backfill sweeps the final files of the calendar's sessions, is delivered again, and sweeps
    once more. Only files of tracked tickers are taken (J9)."""
    paths = ingest.IngestPaths(shared_dir(spark, f"backfill-{uuid.uuid4().hex[:12]}"))
    lines = derived.trade_lines(spark, sf_dir)
    runs = derived.trade_events(spark, sf_dir).select(F.col("reference_date").alias("run_date")).distinct()
    calendar, tracked = audit.trading_calendar(runs), derived.tracked_tickers(spark, sf_dir)
    polled, final = f"{paths.base}/polled", f"{paths.base}/final"
    land_archives(lines.where(F.col("line_no") % 10 <= 3), polled).count()
    land_archives(lines, final).count()
    ingest.process_batch(paths, archives.read_archives(spark, polled), 0, SOURCE_INTRADAY, tracked)
    for batch in (1, 1, 2):
        ingest.backfill(spark, paths, archives.read_archives(spark, final), calendar, batch, tracked)
    return paths


def q_backfill_ingest(spark, sf_dir):
    """The event log of a poll and its backfill, with the source of every event."""
    log = read_event_log(spark, _backfilled(spark, sf_dir).event_log)
    return log.select("batch_id", "source", "ticker", "trade_id", "action", "trade_date", "traded_at")


def q_fetched_files(spark, sf_dir):
    """One audit row per fetched file of the poll and the sweeps, also without a good line."""
    return spark.read.parquet(_backfilled(spark, sf_dir).audit).select(
        "batch_id", "ticker", "session_date", "filename", "total", "published", "last_price", "last_traded_at")


QUERIES.update({
    "backfill_ingest": q_backfill_ingest,
    "fetched_files": q_fetched_files,
})
