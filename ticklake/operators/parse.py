"""Trade-line parsing (one pass, good and malformed rows apart) and event shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.money import comma_decimal, comma_decimal_is_lossy, money_text
from ticklake.functions.text import field_count_error, reason_error
from ticklake.functions.timefmt import iso_date, iso_instant, local_clock_to_utc
from ticklake.schemas import (
    DEAD_LETTER_COLUMNS, PRICE, SCHEMA_VERSION, TRADE_COLUMNS, TRADE_LINE_FIELDS,
)

_INT_TEXT = r"^\s*[+-]?\d+\s*$"


def _integer(text: Column, type_name: str) -> Column:
    # The cast itself trims blanks; the pattern only rejects forms the cast would accept
    # but an integer literal must not have (fractions).
    return F.when(text.rlike(_INT_TEXT), text.try_cast(type_name))


def parse_lines(lines: DataFrame, line_col: str = "raw_line") -> DataFrame:
    """Add the nine typed trade columns, ``parsed_ok`` and ``error`` (NULL for a good line).

    Field order on the line: 0 reference date, 1 ticker, 2 action, 3 price (comma
    decimal), 4 quantity, 5 HHMMSSmmm market clock, 6 trade id, 7 session type,
    8 session date, 9-10 broker codes (not kept, may be empty).
    The first failing field, in the order trade date, id, action, price, quantity, time,
    reference date, session type, names the error.
    """
    line = F.col(line_col)
    c = F.col
    base = [x for x in lines.columns
            if x not in TRADE_COLUMNS and x not in ("error", "parsed_ok", "_n", "_price")]
    # Staged so that each step references columns produced below it. The single-row
    # generators are evaluation barriers: the split is computed once per line, and a
    # filter on ``parsed_ok`` stays above the parse instead of being pushed below it by
    # re-inlining every parse expression into the predicate.
    split = lines.select(*base, F.explode(F.array(F.split(line, ";", -1))).alias("_f"))
    f = c("_f")

    def g(i: int) -> Column:
        return F.get(f, i)

    dated = split.select(*base, "_f", iso_date(g(8)).alias("_trade_date"))
    typed = dated.select(
        *base,
        g(1).alias("ticker"),
        _integer(g(6), "bigint").alias("trade_id"),
        _integer(g(2), "int").alias("action"),
        comma_decimal(g(3), PRICE).alias("price"),
        _integer(g(4), "bigint").alias("quantity"),
        local_clock_to_utc(c("_trade_date"), g(5)).alias("traded_at"),
        c("_trade_date").alias("trade_date"),
        iso_date(g(0)).alias("reference_date"),
        _integer(g(7), "int").alias("session_type"),
        F.size(f).alias("_n"),
        g(3).alias("_price"),
    )
    ok = (c("_n") == TRADE_LINE_FIELDS) & line.isNotNull()
    for name in TRADE_COLUMNS:
        ok = ok & c(name).isNotNull()
    row = F.struct(*TRADE_COLUMNS, "_n", "_price", ok.alias("parsed_ok"))
    keep = base
    parsed = typed.select(*base, F.inline(F.array(row)))
    c = F.col
    reason = (F.when(c("trade_date").isNull(), F.lit("bad_trade_date"))
               .when(c("trade_id").isNull(), F.lit("bad_trade_id"))
               .when(c("action").isNull(), F.lit("bad_action"))
               .when(c("price").isNull() & comma_decimal_is_lossy(c("_price"), PRICE), F.lit("price_scale"))
               .when(c("price").isNull(), F.lit("bad_price"))
               .when(c("quantity").isNull(), F.lit("bad_quantity"))
               .when(c("traded_at").isNull(), F.lit("bad_time"))
               .when(c("reference_date").isNull(), F.lit("bad_reference_date"))
               .when(c("session_type").isNull(), F.lit("bad_session_type")))
    error = (F.when(line.isNull(), F.lit("null line"))
              .when(c("_n") != TRADE_LINE_FIELDS, field_count_error(line, c("_n"), TRADE_LINE_FIELDS))
              .otherwise(F.when(reason.isNotNull(), reason_error(reason, line))))
    return parsed.select(*keep, *TRADE_COLUMNS, "parsed_ok", error.alias("error"))


def parse_trades(lines: DataFrame, line_col: str = "raw_line") -> tuple[DataFrame, DataFrame]:
    """(good trades, malformed lines with their error) from one parse."""
    parsed = parse_lines(lines, line_col)
    return good_rows(parsed), bad_rows(parsed)


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parsed_ok")).drop("parsed_ok", "error")


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("parsed_ok")).drop("parsed_ok")


def dead_letters(malformed: DataFrame) -> DataFrame:
    """Dead-letter envelope: enough context to inspect and reprocess a line. ``ticker``
    is the tracked ticker whose file held the line, not whatever field 1 says."""
    return malformed.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("file_ticker").alias("ticker"),
        "session_date", "filename", "source", "error", "raw_line",
    ).select(*DEAD_LETTER_COLUMNS)


def dead_letter_json(dead: DataFrame) -> DataFrame:
    """Compact JSON value per dead letter, keyed by ticker."""
    return dead.select(
        F.col("ticker").alias("key"),
        F.to_json(F.struct(
            "schema_version", "ticker", F.col("session_date").cast("string").alias("session_date"),
            "filename", "source", "error", "raw_line")).alias("value"),
    )


def trade_event_struct(trades: DataFrame, source: Column | str) -> Column:
    """The 11-field event in publication order; money and instants as text."""
    src = F.lit(source) if isinstance(source, str) else source
    return F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("ticker"),
        F.col("trade_id"),
        F.col("action"),
        money_text(F.col("price")).alias("price"),
        F.col("quantity"),
        iso_instant(F.col("traded_at")).alias("traded_at"),
        F.col("trade_date").cast("string").alias("trade_date"),
        F.col("reference_date").cast("string").alias("reference_date"),
        F.col("session_type"),
        src.alias("source"),
    )


def trade_event_json(trades: DataFrame, source: Column | str = "eod_file") -> DataFrame:
    """Publishable (key, value): key = ticker so one instrument stays in one log partition."""
    return trades.select(F.col("ticker").alias("key"),
                         F.to_json(trade_event_struct(trades, source)).alias("value"))


def event_log_json(events: DataFrame) -> DataFrame:
    """Events whose price is already text (the decoded log) back to their JSON line."""
    return events.select(F.col("ticker").alias("key"), F.to_json(F.struct(
        "schema_version", "ticker", "trade_id", "action", "price", "quantity",
        iso_instant(F.col("traded_at")).alias("traded_at"),
        F.col("trade_date").cast("string").alias("trade_date"),
        F.col("reference_date").cast("string").alias("reference_date"),
        "session_type", "source")).alias("value"))
