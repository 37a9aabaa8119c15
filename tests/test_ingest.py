"""Ingest job end to end: zip archives -> event log/dead letters/cursor/audit -> serve."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from decimal import Decimal

from ticklake.session import shared_dir
from ticklake.sources.archives import ARCHIVE_SCHEMA, archive_lines, read_archives, zip_bytes
from ticklake.sources.events import read_event_log
from ticklake.sources.tables import gold
from ticklake.streaming import ingest, serve
from ticklake.streaming.replay import run_serve_over_drops



def line(trade_id, price="30,500", action=0, ticker="NOVA4", quantity=400, clock="113005250", session=1,
         day="2026-07-14", traded=None):
    """A trade line as the exchange writes it."""
    return ";".join(map(str, (day, ticker, action, price, quantity, clock, trade_id, session, traded or day, 3, 27)))


L10, L20, L30 = line(10), line(20, "30,250", clock="121500000"), line(30, "31,000", clock="150000900")
C10 = line(10, action=2)
AM = line(7005, "12,750", ticker="QUAL3", clock="021500001", session=6, traded="2026-07-13")


def _land(root, ticker, session, name, lines):
    d = os.path.join(root.removeprefix("file:"), f"ticker={ticker}", f"session_date={session}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name + ".zip"), "wb") as f:
        f.write(zip_bytes(f"14-07-2026_NEGOCIOSAVISTA_{ticker}_{name}.txt", lines))


def test_unzip_udtf_drops_header_and_flags_bad_archives(spark):
    root = shared_dir(spark, f"arch-{uuid.uuid4().hex[:8]}")
    _land(root, "NOVA4", "2026-07-14", "1046", [L10, L20])
    bad = os.path.join(root.removeprefix("file:"), "ticker=VALE3", "session_date=2026-07-14")
    os.makedirs(bad)
    open(os.path.join(bad, "x.zip"), "wb").write(b"not a zip")
    rows = archive_lines(read_archives(spark, root)).orderBy("file_ticker", "line_no").collect()
    assert [(r.file_ticker, r.line_no, r.raw_line) for r in rows[:2]] == [
        ("NOVA4", 1, L10), ("NOVA4", 2, L20)]
    assert rows[0].filename == "14-07-2026_NEGOCIOSAVISTA_NOVA4_1046.txt"
    assert rows[2].file_ticker == "VALE3" and rows[2].archive_error.startswith("bad archive")


def test_cumulative_snapshots_publish_only_new_trades(spark):
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}"))
    _land(paths.landing, "NOVA4", "2026-07-14", "1046", [L10, L20, "garbage"])
    _land(paths.landing, "QUAL3", "2026-07-14", "1046", [AM])
    ingest.start(spark, paths, ARCHIVE_SCHEMA).awaitTermination()
    # later snapshot of the same session: everything again, plus one trade and a cancel
    _land(paths.landing, "NOVA4", "2026-07-14", "1106", [L10, L20, L30, C10])
    ingest.start(spark, paths, ARCHIVE_SCHEMA).awaitTermination()

    log = spark.read.parquet(paths.event_log)
    per_batch = sorted((r.batch_id, r.n) for r in log.groupBy("batch_id").count()
                       .withColumnRenamed("count", "n").collect())
    assert per_batch == [(0, 3), (1, 2)]  # second run: trade 30 and the cancellation only
    events = read_event_log(spark, paths.event_log)
    second = {(r.trade_id, r.action) for r in events.filter("batch_id = 1").collect()}
    assert second == {(30, 0), (10, 2)}

    from pyspark.sql import functions as F
    days = spark.sql("SELECT explode(array(date'2026-07-13', date'2026-07-14')) AS trade_date")
    cur = {(r.ticker, r.trade_date): r.max_trade_id
           for r in ingest.cursor_before(spark, paths, 2, days).collect()}
    assert cur == {("NOVA4", dt.date(2026, 7, 14)): 30, ("QUAL3", dt.date(2026, 7, 13)): 7005}

    [dl] = spark.read.parquet(paths.dead_letters).collect()
    assert '"raw_line":"garbage"' in dl.value and dl.key == "NOVA4"

    audit = {(r.filename, r.batch_id): (r.total, r.published, r.last_price)
             for r in spark.read.parquet(paths.audit).collect()}
    assert audit[("14-07-2026_NEGOCIOSAVISTA_NOVA4_1106.txt", 1)] == (4, 2, Decimal("30.500"))

    # folding the cursor's log changes nothing for the next batch
    assert ingest.cursor_log(paths).compact(spark) == 0
    assert cur == {(r.ticker, r.trade_date): r.max_trade_id
                   for r in ingest.cursor_before(spark, paths, 2, days).collect()}

    # the event log feeds the serve job; the cancellation retracts trade 10
    serve_paths = serve.ServePaths(shared_dir(spark, f"serve-{uuid.uuid4().hex[:8]}"))
    from pyspark.sql import functions as F
    decoded = events.drop("batch_id")
    run_serve_over_drops(spark, decoded, F.lit(0), 1, serve_paths.base)
    s = {r.ticker: r for r in gold(spark, serve_paths.summary).collect()}
    assert s["NOVA4"].trades == 2 and s["NOVA4"].open == Decimal("30.250")
    assert s["QUAL3"].trades == 1 and s["QUAL3"].open is None  # after-market only


def _table(spark, path):
    return sorted(map(str, (r.asDict() for r in spark.read.parquet(path).collect())))


def test_a_batch_delivered_again_changes_nothing(spark):
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}"))
    _land(paths.landing, "NOVA4", "2026-07-14", "1046", [L10, L20, C10])
    ingest.process_batch(paths, read_archives(spark, paths.landing), 0)
    second = shared_dir(spark, f"second-{uuid.uuid4().hex[:8]}")
    _land(second, "NOVA4", "2026-07-14", "1106", [L10, L20, L30, C10])
    for _ in range(2):  # the cursor of batch 1 is written when it is delivered again
        ingest.process_batch(paths, read_archives(spark, second), 1)
        state = [_table(spark, p) for p in (paths.event_log, paths.audit, paths.cursor)]
        if _ == 0:
            first = state
    assert state == first
    log = spark.read.parquet(paths.event_log)
    assert {r.batch_id: r["count"] for r in log.groupBy("batch_id").count().collect()} == {0: 3, 1: 2}


def test_cumulative_snapshots_in_one_batch_publish_a_trade_once(spark):
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}"))
    for k, lines in enumerate(([L10], [L10, L20], [L10, L20, L30])):
        _land(paths.landing, "NOVA4", "2026-07-14", f"10{k}0", lines)
    ingest.process_batch(paths, read_archives(spark, paths.landing), 0)
    assert spark.read.parquet(paths.event_log).count() == 3


def test_every_landed_file_has_an_audit_row_and_the_watchlist_decides(spark):
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}"))
    _land(paths.landing, "NOVA4", "2026-07-14", "good", [L10])
    _land(paths.landing, "NOVA4", "2026-07-14", "bad", ["x", "y;z"])
    _land(paths.landing, "NOVA4", "2026-07-14", "none", [])
    _land(paths.landing, "ABCD3", "2026-07-14", "other", [L10])
    tracked = spark.createDataFrame([("NOVA4",)], "ticker string")
    ingest.process_batch(paths, read_archives(spark, paths.landing), 0, tracked=tracked)
    got = {r.filename.split("_")[-1]: (r.total, r.published) for r in spark.read.parquet(paths.audit).collect()}
    assert got == {"good.txt": (1, 1), "bad.txt": (0, 0), "none.txt": (0, 0)}


def test_damaged_archives_are_one_error_row_each(spark):
    root = shared_dir(spark, f"arch-{uuid.uuid4().hex[:8]}")
    body = zip_bytes("m.txt", [f"line number {k} with some text" for k in range(500)])
    cut = bytearray(body)
    cut[120:200] = bytes(80)
    locked = bytearray(body)
    locked[6] |= 1  # the encrypted flag, in both headers
    locked[body.index(b"PK\x01\x02") + 8] |= 1
    for k, raw in enumerate((bytes(cut), bytes(locked), zip_bytes("m.txt", ["caf\u00e9"]), body)):
        folder = os.path.join(root.removeprefix("file:"), "ticker=VALE3", f"session_date=2026-07-{k + 1:02d}")
        os.makedirs(folder)
        with open(os.path.join(folder, "a.zip"), "wb") as f:
            f.write(raw)
    rows = archive_lines(read_archives(spark, root)).collect()
    assert sum(r.archive_error is not None for r in rows) == 3
    assert sum(r.raw_line is not None for r in rows) == 500


def test_a_trade_listed_again_by_another_sessions_file_is_published_once(spark):
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}"))
    _land(paths.landing, "NOVA4", "2026-07-14", "a", [L10, L20])
    _land(paths.landing, "NOVA4", "2026-07-15", "b", [L20, line(5, day="2026-07-15")])
    ingest.process_batch(paths, read_archives(spark, paths.landing), 0)
    got = sorted((r.trade_id, str(r.trade_date)) for r in read_event_log(spark, paths.event_log).collect())
    assert got == [(5, "2026-07-15"), (10, "2026-07-14"), (20, "2026-07-14")]


def test_files_of_one_batch_may_split_a_sessions_ids(spark):
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}"))
    _land(paths.landing, "NOVA4", "2026-07-14", "a", [L10, L30])
    _land(paths.landing, "NOVA4", "2026-07-15", "b", [L20, L30])
    ingest.process_batch(paths, read_archives(spark, paths.landing), 0)
    assert sorted(r.trade_id for r in read_event_log(spark, paths.event_log).collect()) == [10, 20, 30]


def test_backfill_publishes_what_a_poll_missed_as_eod_file(spark):
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}"))
    _land(paths.landing, "NOVA4", "2026-07-14", "a", [L10])
    ingest.process_batch(paths, read_archives(spark, paths.landing), 0, source="intraday_poll")
    final = shared_dir(spark, f"final-{uuid.uuid4().hex[:8]}")
    _land(final, "NOVA4", "2026-07-14", "a", [L10, L20])
    _land(final, "NOVA4", "2026-07-18", "w", [line(40, day="2026-07-18")])  # no session of the calendar
    calendar = spark.sql("SELECT date'2026-07-14' AS session_date")
    for batch in (1, 1, 2):
        ingest.backfill(spark, paths, read_archives(spark, final), calendar, batch)
    got = [(r.batch_id, r.source, r.trade_id) for r in read_event_log(spark, paths.event_log).collect()]
    assert sorted(got) == [(0, "intraday_poll", 10), (1, "eod_file", 20)]


def test_ids_that_the_cursor_holds_back_are_listed(spark):
    paths = ingest.IngestPaths(shared_dir(spark, f"ingest-{uuid.uuid4().hex[:8]}"))
    _land(paths.landing, "NOVA4", "2026-07-14", "a", [L10, L30])
    ingest.process_batch(paths, read_archives(spark, paths.landing), 0)
    second = shared_dir(spark, f"second-{uuid.uuid4().hex[:8]}")
    _land(second, "NOVA4", "2026-07-14", "b", [L10, L20, L30, line(31), C10])  # 20 comes after 30
    for _ in range(2):
        ingest.process_batch(paths, read_archives(spark, second), 1)
        assert [(r.ticker, r.trade_id, r.batch_id) for r in spark.read.parquet(paths.late).collect()] == [("NOVA4", 20, 1)]


def test_large_archives_are_streamed_and_give_the_same_rows(spark):
    root = shared_dir(spark, f"arch-{uuid.uuid4().hex[:8]}")
    many = [line(k) for k in range(1, 25_000)]
    for k, (name, lines) in enumerate((("a", many), ("b", []), ("c", ["caf\u00e9"]), ("d", [L10]))):
        _land(root, "NOVA4", f"2026-07-1{k}", name, lines)
    with open(os.path.join(root.removeprefix("file:"), "ticker=NOVA4", "session_date=2026-07-13", "e.zip"), "wb") as f:
        f.write(b"not a zip")
    both = [sorted((r.archive, r.line_no or 0, str(r.raw_line), r.filename, r.file_ticker, r.session_date, r.landed_at,
                    str(r.archive_error)[:11]) for r in archive_lines(read_archives(spark, root), inline=n).collect())
            for n in (1 << 26, 0)]
    assert both[0] == both[1] and len(both[0]) == len(many) + 4


def test_an_archive_larger_than_the_memory_is_read(spark):
    """A worker that may take 150 MB reads a member of 400 MB."""
    import subprocess
    import sys
    import zipfile
    path = os.path.join(shared_dir(spark, f"big-{uuid.uuid4().hex[:8]}").removeprefix("file:"), "big.zip")
    block = "".join(line(k) + "\n" for k in range(20_000))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("m.txt", "w") as member:
        member.write(b"header\n")
        for _ in range(400_000_000 // len(block)):
            member.write(block.encode())
    code = ("import resource, sys; sys.path.insert(0, '.'); import pyarrow, pyarrow.fs, numpy\n"
            "from ticklake.sources.archives import _stream_paths\n"
            "base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            f"batch = pyarrow.RecordBatch.from_pydict({{'path': ['file://{path}']}})\n"
            "n = sum(b.num_rows for b in _stream_paths([batch]))\n"
            "print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) // 1024)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), check=True).stdout.split()
    assert int(out[0]) == 20_000 * (400_000_000 // len(block)) and int(out[1]) < 150


def test_audit_and_ids_need_no_sort(spark):
    """The batch's widest steps hold numbers only: no row with its line is sorted or windowed."""
    import datetime as dt

    from ticklake.operators import audit
    at, day = dt.datetime(2026, 7, 14, 9), dt.date(2026, 7, 14)
    rows = [("PETR4", day, 1, 0, "a", at, "f", 5, "x", True, 1), ("PETR4", day, 1, 0, "b", at, "f", 5, "y", True, 2),
            ("PETR4", day, 2, 0, "a", at, "f", 6, "z", False, 3), ("PETR4", day, 3, 2, "b", at, "g", 7, "z", False, 4)]
    df = spark.createDataFrame(rows, "ticker string, trade_date date, trade_id long, action int, archive string, landed_at timestamp, "
                                     "filename string, line_no long, raw_line string, is_new boolean, price int").selectExpr(
        "*", "ticker as file_ticker", "trade_date as session_date", "landed_at as traded_at")
    counts, ids = audit.file_counts(df), ingest.listed_ids(df)
    for frame in (counts, ids):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "Sort" not in plan and "Window" not in plan
    assert {(r.trade_id, r.several) for r in ids.collect()} == {(1, True), (2, False)}
    two = sorted(map(tuple, audit.publish_audit_of(df, counts).collect()))
    assert two == sorted(map(tuple, audit.publish_audit(df).collect())) and two[0][5] == 2
