"""The line parser, field by field: each table row changes one field of a valid line."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from ticklake.operators import parse

FIELDS = ["reference_date", "ticker", "action", "price", "quantity", "time", "trade_id", "session_type",
          "trade_date", "buyer", "seller"]
VALID = ["2025-03-11", "WEGE3", "0", "52,070", "300", "141503250", "771", "1", "2025-03-11", "", "17"]


def line(**changes: str) -> str:
    return ";".join(changes.get(name, value) for name, value in zip(FIELDS, VALID, strict=True))


@pytest.fixture
def parsed(lines_df):
    def run(*lines):
        return parse.parse_lines(lines_df(list(lines))).orderBy("line_no").collect()
    return run


def test_a_valid_line_is_typed(parsed):
    [row] = parsed(line())
    assert row.error is None
    assert (row.ticker, row.action, row.price, row.quantity, row.trade_id, row.session_type) == (
        "WEGE3", 0, Decimal("52.070"), 300, 771, 1)
    assert row.trade_date == row.reference_date == dt.date(2025, 3, 11)
    assert row.traded_at == dt.datetime(2025, 3, 11, 17, 15, 3, 250000)  # three hours behind UTC


@pytest.mark.parametrize("changes, field, value", [
    (dict(buyer="8", seller=""), "error", None),
    (dict(buyer="", seller=""), "error", None),
    (dict(action="2"), "action", 2),
    (dict(trade_date="20250310"), "trade_date", dt.date(2025, 3, 10)),
    (dict(session_type="6", trade_date="2025-03-10"), "reference_date", dt.date(2025, 3, 11)),
    (dict(time="000000000"), "traded_at", dt.datetime(2025, 3, 11, 3, 0)),
    (dict(time="235959999"), "traded_at", dt.datetime(2025, 3, 12, 2, 59, 59, 999000)),
    (dict(price="0"), "price", Decimal("0.000")),
    (dict(price="1,5000"), "price", Decimal("1.500")),  # zeros beyond the scale lose nothing
    (dict(reference_date="2019-02-15", trade_date="2019-02-15", time="233000000"), "traded_at",
     dt.datetime(2019, 2, 16, 1, 30)),  # summer time
    (dict(reference_date="2017-10-15", trade_date="2017-10-15", time="001500000"), "traded_at",
     dt.datetime(2017, 10, 15, 3, 15)),  # an hour the clocks skipped
])
def test_accepted_variants(parsed, changes, field, value):
    [row] = parsed(line(**changes))
    assert row.error is None and row[field] == value


@pytest.mark.parametrize("reason, changes", [
    ("bad_reference_date", dict(reference_date="11/03/2025")),
    ("bad_trade_date", dict(trade_date="2025")),
    ("bad_trade_date", dict(trade_date="2025-3-11")),
    ("bad_trade_date", dict(trade_date="2025-02-30")),
    ("bad_action", dict(action="new")),
    ("bad_price", dict(price="n/a")),
    ("bad_price", dict(price="NaN")),
    ("price_scale", dict(price="52,0705")),
    ("price_scale", dict(price="52,0700000000000000000001")),
    ("bad_time", dict(time="1415")),
    ("bad_time", dict(time="141560000")),
    ("bad_time", dict(time="240000000")),
    ("bad_trade_id", dict(trade_id="7_1")),
    ("bad_trade_id", dict(trade_id="x", price="y")),  # the earlier check names the error
])
def test_rejected_fields(parsed, reason, changes):
    [row] = parsed(line(**changes))
    assert not row.parsed_ok and row.error.startswith(reason)


@pytest.mark.parametrize("raw, error", [
    ("one;two", "expected 11 fields, got 2: 'one;two'"),
    ("", "expected 11 fields, got 1: ''"),
    ("o'clock", "expected 11 fields, got 1: \"o'clock\""),
])
def test_field_counts_are_named(parsed, raw, error):
    assert parsed(raw)[0].error == error


def test_every_line_goes_one_way(lines_df):
    lines = [line(), "junk", line(ticker="RADL3"), line(price="-")]
    good, bad = parse.parse_trades(lines_df(lines))
    assert {r.ticker for r in good.collect()} == {"WEGE3", "RADL3"}
    assert {r.raw_line for r in bad.collect()} == {"junk", line(price="-")}


def test_dead_letters_name_their_file(lines_df):
    import json

    df = lines_df(["junk"], ticker="WEGE3", session="2025-03-11", filename="w.txt")
    [row] = parse.dead_letter_json(parse.dead_letters(parse.bad_rows(parse.parse_lines(df)))).collect()
    body = json.loads(row.value)
    assert row.key == body["ticker"] == "WEGE3"
    assert (body["filename"], body["raw_line"], body["session_date"]) == ("w.txt", "junk", "2025-03-11")
    assert body["schema_version"] == 1 and body["error"].startswith("expected 11 fields")
