"""Cursor state of a stream, interval sets of ids, stored digests, contracts on write, line numbers."""

from __future__ import annotations

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ticklake.operators import intervals
from ticklake.session import shared_dir
from ticklake.sinks import contracts, snapshots
from ticklake.sources.archives import read_lines
from ticklake.streaming import cursor_state

D = dt.date(2026, 7, 14)
TRADES = "ticker string, trade_date date, trade_id long, action int, quantity long"


@pytest.fixture
def base(spark):
    return shared_dir(spark, f"state-{uuid.uuid4().hex[:8]}")


def _trades(spark, rows):
    return spark.createDataFrame([(t, D, i, a, 1) for t, i, a in rows], TRADES)


def _published(spark, base):
    rows = spark.read.parquet(cursor_state.published_path(base)).collect()
    return sorted((r.batch_id, r.ticker, r.trade_id, r.action) for r in rows)


def test_cursor_stream_follows_a_model(spark, base, monkeypatch):
    """A hot session and small ones, snapshots that grow, each batch delivered twice."""
    monkeypatch.setattr(cursor_state, "FOLD_EVERY", 2)
    rng = random.Random(6)
    tops, want, ids = {}, [], {t: [0] for t in ("HOT4", "A3", "B3")}
    for batch in range(5):
        rows = []
        for t in ids:
            ids[t] += [ids[t][-1] + rng.randint(1, 3) for _ in range(300 if t == "HOT4" else rng.randint(0, 2))]
            rows += [(t, i, 0) for i in ids[t][1:]] + [(t, rng.choice(ids[t]), 2)]
        rows += rows[:5]  # lines that the snapshot repeats
        before = dict(tops)
        for t, i, a in rows:
            if a == 2 or i > before.get(t, 0):
                want.append((batch, t, i, a))
                if a != 2:
                    tops[t] = max(tops.get(t, 0), i)
        for _ in range(2):
            cursor_state.process_batch(base, _trades(spark, rows).repartition(6), batch)
        assert _published(spark, base) == sorted(want)
        state = {r.ticker: r.max_trade_id for r in cursor_state.cursor_before(spark, base).collect()}
        assert state == tops
    assert cursor_state.state(base).compact(spark) == 3


def test_cursor_stream_of_nothing(spark, base):
    cursor_state.process_batch(base, _trades(spark, []), 0)
    assert cursor_state.cursor_before(spark, base).count() == 0


def test_intervals_against_sets(spark, monkeypatch):
    monkeypatch.setattr(intervals, "BLOCK_BITS", 4)
    rng = random.Random(2)
    ids = {t: {rng.randint(-40, 200) for _ in range(120)} for t in ("A", "B")}
    sent = _trades(spark, [(t, i, 0) for t in ids for i in ids[t]] + [("A", i, 0) for i in list(ids["A"])[:9]])
    parts = intervals.islands(sent)
    assert parts.where("first_id div 16 <> last_id div 16 and first_id >= 0").count() == 0
    whole = intervals.merged(parts).collect()
    for t in ids:
        mine = sorted((r.first_id, r.last_id) for r in whole if r.ticker == t)
        assert {i for a, b in mine for i in range(a, b + 1)} == ids[t]
        assert all(b + 1 < c for (_, b), (c, _) in zip(mine, mine[1:], strict=False))
    assert sum(r.ids for r in whole) == sum(map(len, ids.values()))
    came = [(t, i, 0) for t in ("A", "B", "C") for i in range(-50, 210)] + [("A", -45, 2)]
    marked = _trades(spark, came).withColumn("is_new", F.col("trade_id") > 150)
    got = {(r.ticker, r.trade_id) for r in intervals.late(marked, parts).collect()}
    assert got == {(t, i) for t, i, a in came if i <= 150 and a == 0 and i not in ids.get(t, ())}


def test_changes_between_stored_digests(spark, base):
    def feed(version=None):
        return sorted((r.key, r.change, r.digest_before, r.digest_now) for r in snapshots.changes(spark, base, version).collect())

    versions = [{"A": "1", "B": "2"}, {"A": "1", "B": "3", "C": "4"}, {"C": "4", "B": "3"}, {}]
    feeds = [[("A", "added", None, "1"), ("B", "added", None, "2")], [("B", "changed", "2", "3"), ("C", "added", None, "4")],
             [("A", "gone", "1", None)], [("B", "gone", "3", None), ("C", "gone", "4", None)]]
    assert feed() == []
    for n, (rows, want) in enumerate(zip(versions, feeds, strict=True), 1):
        df = spark.createDataFrame(list(rows.items()), "ticker string, etag string")
        df.write.parquet(f"{base}/{n}/broken")  # what a job that stopped before the pointer left
        assert snapshots.store(df, base) == n
        assert feed() == want
    assert feed(2) == feeds[1]


def test_contract_on_write(spark, base):
    rows = [("A", 1), ("B", None), (None, -1), ("C", 0), ("C", 5)]
    path = f"{base}/t"
    got = contracts.write(spark.createDataFrame(rows, "k string, n int"), path, ["k"], {"n above 0": F.col("n") > 0})
    assert got == {"rows": 5, "not null k": 1, "n above 0": 3}
    assert sorted(map(tuple, contracts.read(spark, path).collect())) == [("A", 1), ("C", 5)]
    held = {(r.k, r.n): r.broken_rules for r in contracts.quarantine(spark, path).collect()}
    assert held == {("B", None): ["n above 0"], ("C", 0): ["n above 0"], (None, -1): ["not null k", "n above 0"]}
    assert [tuple(r) for r in contracts.repeated_keys(spark, path, ["k"]).collect()] == [("C", 2)]


def test_lines_of_split_files_are_numbered(spark, base):
    rng = random.Random(3)
    files = {("A", "x.txt"): 5000, ("B", "x.txt"): 1, ("B", "y.txt"): 700}
    for (ticker, name), n in files.items():
        folder = os.path.join(base.removeprefix("file:"), f"ticker={ticker}")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w") as f:
            f.writelines(f"{k}{'z' * rng.choice([0, 1, 30])}\n" for k in range(n))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_lines(spark, base)
        rows = df.collect()
        splits = spark.read.text(base).select("_metadata.file_block_start").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert splits > 10 and len(rows) == sum(files.values())
    assert all(int(r.raw_line.rstrip("z")) == r.line_no for r in rows)
    assert {(r.ticker, r.filename) for r in rows} == set(files)
