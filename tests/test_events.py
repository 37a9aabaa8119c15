"""The published event: its JSON, and decoding whatever the log holds."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticklake.operators import parse, views
from ticklake.sources.events import decode_trade_events, decode_values

LINE = "2025-05-20;RADL3;0;27,310;1200;112233044;88;1;2025-05-20;3;"
#: The public contract: names and order of an event's fields.
CONTRACT = ["schema_version", "ticker", "trade_id", "action", "price", "quantity", "traded_at", "trade_date",
            "reference_date", "session_type", "source"]


@pytest.fixture
def publish(lines_df):
    def run(*lines, source="eod_file"):
        good = parse.good_rows(parse.parse_lines(lines_df(list(lines))))
        return parse.trade_event_json(good, source)
    return run


def test_field_order_types_and_spacing(publish):
    row = publish(LINE, source="intraday_poll").first()
    body = json.loads(row.value)
    assert list(body) == CONTRACT
    assert row.value == json.dumps(body, separators=(",", ":"))  # compact
    assert row.key == body["ticker"] == "RADL3" and body["source"] == "intraday_poll"
    assert {k: type(v).__name__ for k, v in body.items() if type(v) is not str} == dict.fromkeys(
        ["schema_version", "trade_id", "action", "quantity", "session_type"], "int")


@pytest.mark.parametrize("time, text", [
    ("112233044", "2025-05-20T14:22:33.044000+00:00"),
    ("112233000", "2025-05-20T14:22:33+00:00"),
    ("000000001", "2025-05-20T03:00:00.001000+00:00"),
])
def test_instants_are_utc_text(publish, time, text):
    body = json.loads(publish(LINE.replace("112233044", time)).first().value)
    assert body["traded_at"] == text


@pytest.mark.parametrize("price, text", [("27,310", "27.310"), ("0,1", "0.100"), ("1200", "1200.000")])
def test_prices_are_text_with_three_decimals(publish, price, text):
    assert json.loads(publish(LINE.replace("27,310", price)).first().value)["price"] == text


def test_round_trip_in_any_session_zone(spark, publish):
    events = publish(LINE, LINE.replace(";88;", ";89;").replace(";0;27", ";2;27"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Asia/Kolkata", "America/Sao_Paulo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = decode_trade_events(events.select("value")).orderBy("trade_id").collect()
            assert [(r.trade_id, r.action, r.price, r.quantity) for r in rows] == [
                (88, 0, "27.310", 1200), (89, 2, "27.310", 1200)]
            assert {r.traded_at for r in rows} == {dt.datetime(2025, 5, 20, 14, 22, 33, 44000)}
            assert {r.trade_date for r in rows} == {dt.date(2025, 5, 20)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_price_that_would_be_rounded_is_null_as_in_the_parser(spark, publish):
    body = json.loads(publish(LINE).first().value)
    texts = ["27.3105", "27.31000000", 27.31, "x", None, "1e2", "27.310000000000000000001"]
    df = spark.createDataFrame([(json.dumps(body | {"price": p, "trade_id": k}),) for k, p in enumerate(texts)],
                               "value string")
    got = {r.trade_id: r.price for r in views.trades_clean(decode_trade_events(df)).collect()}
    assert got == {0: None, 1: Decimal("27.310"), 2: Decimal("27.310"), 3: None, 4: None, 5: Decimal("100.000"), 6: None}


def test_decoding_never_fails(spark):
    texts = {'{"n": 4}': 4, '{"n": "4"}': 4, '{"n": [4]}': None, "<xml/>": None, "": None, '{"m": 1}': None, '[{"n":4}]': None}
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r.value: r.n for r in decode_values(df.select("value", F.col("value").alias("raw")), "n BIGINT").collect()} \
        if "value" in decode_values(df, "n BIGINT").columns else None
    rows = decode_values(df.withColumn("id", F.monotonically_increasing_id()), "n BIGINT").collect()
    assert len(rows) == len(texts)
    numbers = sorted(r.n for r in rows if r.n is not None)
    assert numbers in ([4], [4, 4]) and (got is None or len(got) == len(texts))
