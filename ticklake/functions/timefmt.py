"""Date and time expressions. None of them depends on ``spark.sql.session.timeZone``.

Instants are kept as UTC wall clocks in TIMESTAMP_NTZ columns; zone conversion uses
``convert_timezone`` between explicit zones only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklake.schemas import MARKET_ZONE, WINDOW_END, WINDOW_START


def iso_date(text: Column) -> Column:
    """ISO calendar date: 'YYYY-MM-DD' or compact 'YYYYMMDD'; anything else is NULL."""
    return (F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
             .when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd")))


def br_date(text: Column) -> Column:
    """'dd/mm/yyyy' with one- or two-digit day and month; invalid dates are NULL."""
    month = F.substring_index(F.substring_index(text, "/", 2), "/", -1)
    iso = F.concat_ws("-", F.substring_index(text, "/", -1), month, F.substring_index(text, "/", 1))
    return F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), iso.try_cast("date"))


def br_payment_date(text: Column, sentinel: str) -> Column:
    """Like ``br_date`` but the 'to be defined' sentinel maps to NULL (the row is kept)."""
    return F.when(text == sentinel, F.lit(None).cast("date")).otherwise(br_date(text))


def local_clock_to_utc(trade_date: Column, hhmmssmmm: Column, zone: str = MARKET_ZONE) -> Column:
    """Market wall clock 'HHMMSSmmm' on ``trade_date`` -> UTC instant (TIMESTAMP_NTZ).

    NULL unless the text is exactly nine digits with hour < 24, minute < 60, second < 60.
    """
    hh = F.substring(hhmmssmmm, 1, 2).try_cast("int")
    mi = F.substring(hhmmssmmm, 3, 2).try_cast("int")
    ss = F.substring(hhmmssmmm, 5, 2).try_cast("int")
    ms = F.substring(hhmmssmmm, 7, 3).try_cast("int")
    valid = hhmmssmmm.rlike(r"^\d{9}$") & (hh < 24) & (mi < 60) & (ss < 60) & trade_date.isNotNull()
    millis = (ss * 1000 + ms).cast("decimal(12,0)")
    secs = (millis / F.lit(1000)).cast("decimal(8,6)")
    local = F.try_make_timestamp_ntz(F.year(trade_date), F.month(trade_date),
                                     F.dayofmonth(trade_date), hh, mi, secs)
    return F.when(valid, F.convert_timezone(F.lit(zone), F.lit("UTC"), local))


def utc_to_local(utc_ntz: Column, zone: str = MARKET_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ntz)


def local_date(utc_ntz: Column, zone: str = MARKET_ZONE) -> Column:
    """Calendar date in the market zone of a UTC instant (the market's 'today')."""
    return F.to_date(utc_to_local(utc_ntz, zone))


def utc_literal(as_of: str | _dt.datetime) -> Column:
    """A UTC instant parameter as a TIMESTAMP_NTZ literal (no session-zone involvement)."""
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        as_of = as_of.isoformat(sep=" ")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def iso_instant(utc_ntz: Column) -> Column:
    """UTC instant -> 'YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00' (fraction only when non-zero)."""
    s = utc_ntz.cast("string")
    head = F.replace(F.substring(s, 1, 19), F.lit(" "), F.lit("T"))
    frac = F.when(F.length(s) > 19, F.rpad(F.substring(s, 20, 7), 7, "0")).otherwise(F.lit(""))
    return F.when(utc_ntz.isNotNull(), F.concat(head, frac, F.lit("+00:00")))


def iso_date_text(d: Column) -> Column:
    return d.cast("string")


def br_date_text(d: Column) -> Column:
    """Date -> 'dd/MM/yyyy'."""
    return F.date_format(d, "dd/MM/yyyy")


def decode_instant(ts: Column) -> Column:
    """Zone-aware TIMESTAMP (e.g. decoded from JSON) -> UTC wall clock, whatever the session zone."""
    micros = F.unix_micros(ts).cast("decimal(20,0)")
    seconds = (micros / F.lit(1000000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds)


def market_window_open(utc_ntz: Column, zone: str = MARKET_ZONE) -> Column:
    """Weekday and WINDOW_START <= local time <= WINDOW_END in the market zone."""
    local = utc_to_local(utc_ntz, zone)
    clock = F.substring(local.cast("string"), 12, 100)
    return (F.weekday(F.to_date(local)) < 5) & (clock >= F.lit(WINDOW_START)) & (
        clock <= F.lit(WINDOW_END))


def age_seconds(now_ntz: Column, then_ntz: Column) -> Column:
    """Whole seconds from ``then`` to ``now``, truncated toward zero."""
    diff = F.timestamp_diff("MICROSECOND", then_ntz, now_ntz)
    # Integral division truncates toward zero, like int(timedelta.total_seconds()).
    whole = F.when(diff >= 0, F.floor(diff / F.lit(1000000))).otherwise(
        -F.floor(-diff / F.lit(1000000)))
    return F.when(then_ntz.isNotNull(), whole.cast("long"))
