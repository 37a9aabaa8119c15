"""Corporate actions under one pointer, the folded cursor log, the pointer itself."""

from __future__ import annotations

import json
import uuid

import pytest

from ticklake.operators import cursor
from ticklake.session import shared_dir
from ticklake.sinks import corporate_actions, pointer
from ticklake.sinks.cursor_log import CursorLog

FIRST, SECOND = "2024-03-04 12:00:00", "2024-03-04 18:00:00"
TICKERS = {"NOVA": "NOVA4", "QUAL": "QUAL3", "ZETA": "ZETA3"}


def _row(issuer, **over):
    isin = f"BR{issuer}{'ACNPR' if TICKERS[issuer][-1] == '4' else 'ACNOR'}2"
    return {"isinCode": isin, "assetIssued": isin, "label": "DIVIDENDO", "approvedOn": "09/02/2024",
            "lastDatePrior": "19/02/2024", "paymentDate": "20/03/2024", "rate": "0,75", "relatedTo": "", **over}


def _body(issuer, cash=0, stock=0):
    return json.dumps({"cashDividends": [_row(issuer, rate=f"{k + 1},5") for k in range(cash)],
                       "stockDividends": [_row(issuer, factor=f"{k + 2},0", label="GRUPAMENTO") for k in range(stock)]})


def _sync(spark, base, at, **bodies):
    docs = spark.createDataFrame([(k, issuer, body) for k, (issuer, body) in enumerate(bodies.items())],
                                 "doc_id long, issuing_company string, body string")
    watched = spark.createDataFrame([(t, i) for i, t in TICKERS.items()], "ticker string, issuing_company string")
    corporate_actions.sync(docs, watched, base, at)


def _stored(spark, base):
    return [sorted((r.ticker, str(r.synced_at)[11:13]) for r in df.collect()) for df in corporate_actions.read(spark, base)]


@pytest.fixture
def base(spark):
    return shared_dir(spark, f"ca-{uuid.uuid4().hex[:8]}")


def test_tickers_are_replaced_whole(spark, base):
    assert _stored(spark, base) == [[], []]
    twice = json.loads(_body("NOVA", cash=1))
    twice["cashDividends"] *= 2  # the same row listed twice is one row
    _sync(spark, base, FIRST, NOVA=json.dumps(twice), QUAL=_body("QUAL", cash=2), ZETA=_body("ZETA", stock=1))
    assert _stored(spark, base) == [[("NOVA4", "12"), ("QUAL3", "12"), ("QUAL3", "12")], [("ZETA3", "12")]]
    # NOVA's fetch fails and keeps its rows, QUAL has nothing left, ZETA is replaced
    _sync(spark, base, SECOND, NOVA="", QUAL=_body("QUAL"), ZETA=_body("ZETA", cash=1, stock=1))
    assert _stored(spark, base) == [[("NOVA4", "12"), ("ZETA3", "18")], [("ZETA3", "18")]]
    cash, _ = corporate_actions.read(spark, base, live_only=False)
    assert [r.ticker for r in cash.collect() if r.is_marker] == ["QUAL3"]
    before = _stored(spark, base)
    corporate_actions.vacuum(spark, base)
    assert _stored(spark, base) == before
    assert len(pointer.subfolders(spark, f"{base}/cash_dividends")) == 2 and len(pointer.subfolders(spark, f"{base}/manifest")) == 1


@pytest.mark.parametrize("step", ["stock", "manifest", "pointer"])
def test_a_sync_that_stops_half_way_shows_the_old_pair(spark, base, monkeypatch, step):
    _sync(spark, base, FIRST, NOVA=_body("NOVA", cash=1, stock=1))
    old = _stored(spark, base)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "stock":  # the cash rows are written, the stock rows are not
            m.setattr(corporate_actions.dv, "STOCK_COLUMNS", ["no_such_column"])
            m.setattr(corporate_actions.dv, "parse_stock_rows", lambda u: u.sparkSession.range(1).selectExpr(
                "raise_error('lost') AS ticker"))
            m.setattr(corporate_actions.dv, "for_tracked", lambda rows, w, columns: rows)
        else:
            m.setattr(corporate_actions, "synced_tickers" if step == "manifest" else "_pointer", stop)
            if step == "pointer":
                m.setattr(corporate_actions, "_manifest", lambda s, b: s.createDataFrame([], "ticker string, sync string"))
        with pytest.raises(Exception, match="lost"):
            _sync(spark, base, SECOND, NOVA=_body("NOVA", cash=3), QUAL=_body("QUAL", cash=1))
    assert len(pointer.subfolders(spark, f"{base}/cash_dividends")) >= 1
    assert _stored(spark, base) == old
    _sync(spark, base, SECOND, NOVA=_body("NOVA", cash=3), QUAL=_body("QUAL", cash=1))
    assert _stored(spark, base) == [[("NOVA4", "18")] * 3 + [("QUAL3", "18")], []]


def test_pointer(spark, base):
    path = f"{base}/now.json"
    assert pointer.resolve(spark, path) is None
    for value in ({"v": 1}, {"v": 2, "name": "São"}):
        pointer.publish(spark, path, value)
        assert pointer.resolve(spark, path) == value


def _records(spark, batch, **values):
    rows = [(k, None if v is None else json.dumps({"max_trade_id": v}), 0, batch, f"t{k}") for k, v in values.items()]
    return spark.createDataFrame(rows, "key string, value string, partition int, offset long, kind string")


def _cursor(spark, log, before=None):
    return {r.key: r.max_trade_id for r in cursor.fold_log(log.records(spark, before)).collect()}


@pytest.mark.parametrize("extra", [{}, {"kind": "string"}])
def test_cursor_log_is_the_same_before_and_after_compaction(spark, base, extra):
    log = CursorLog(f"{base}/log", extra)
    batches = [dict(a=1, b=5), dict(a=3, b=None), dict(c=7), dict(b=9, c=None), dict(a=4)]
    assert log.compact(spark) == -1
    for k, values in enumerate(batches):
        log.append(_records(spark, k, **values), k)
        before = [_cursor(spark, log, n) for n in (k, None)]
        assert log.compact(spark) == k - 1
        assert [_cursor(spark, log, n) for n in (k, None)] == before
        log.append(_records(spark, k, **values), k)  # the newest batch, delivered again
        assert [_cursor(spark, log, n) for n in (k, None)] == before
    assert _cursor(spark, log) == {"a": 4, "b": 9}
    assert _cursor(spark, log, 4) == {"a": 3, "b": 9}
    # the tail below the older base is gone, and with it what a batch before it would read
    assert log._tail(spark).selectExpr("min(batch_id)").first()[0] == 3
    with pytest.raises(ValueError, match="folded"):
        log.records(spark, before=1)


def test_newest_documents_come_undecoded(spark, tmp_path):
    rows = [("CO1", 1, '{"cashDividends":[]}'), ("CO1", 3, "no json"), ("CO1", 2, '{"stockDividends":[]}'), ("CO2", 9, "")]
    docs = spark.createDataFrame(rows, "issuing_company string, doc_id long, body string")
    got = corporate_actions.newest_documents(docs, str(tmp_path / "newest"))
    assert [tuple(r) for r in got.collect()] == [rows[2]]
    assert got.columns == docs.columns
