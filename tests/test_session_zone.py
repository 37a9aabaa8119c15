"""Results must not depend on the session time zone (the deployment owns the session)."""

from __future__ import annotations

import pytest

from ticklake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
ZONE_SENSITIVE = ["parse_trade_lines", "trade_events_json", "pending_dividends", "health_report",
                  "dividend_status", "parse_cash_dividends", "download_classes", "trading_calendar"]


def _rows(spark, name):
    return sorted(tuple(str(v) for v in r) for r in QUERIES[name](spark, SF).collect())


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_same_result_in_any_session_zone(spark, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = _rows(spark, name)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = _rows(spark, name)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        ist = _rows(spark, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert utc == ny == ist
