"""String expressions: keys, error texts, content hashes, label maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklake.schemas import TYPE_SHORT


def cursor_key(ticker: Column, trade_date: Column) -> Column:
    """'PETR4:2026-07-14' - one cursor per ticker and session."""
    return F.concat_ws(":", ticker, trade_date.cast("string"))


def py_repr(text: Column) -> Column:
    """Python ``repr`` of a printable string: single quotes unless the text holds a single
    quote and no double quote; backslashes doubled, the chosen quote escaped."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    use_double = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    return F.when(use_double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))


def field_count_error(line: Column, n_fields: Column, expected: int) -> Column:
    """'expected 11 fields, got 3: 'not;enough;fields''."""
    return F.concat(F.lit(f"expected {expected} fields, got "), n_fields.cast("string"),
                    F.lit(": "), py_repr(line))


def reason_error(reason: Column, line: Column) -> Column:
    """Stable reason code plus the offending line: 'bad_price: '...''."""
    return F.concat(reason, F.lit(": "), py_repr(line))


def etag(document: Column) -> Column:
    """Quoted first 16 hex digits of SHA-256 of the document text."""
    return F.concat(F.lit('"'), F.substring(F.sha2(document, 256), 1, 16), F.lit('"'))


def normalize_ticker(raw: Column) -> Column:
    return F.upper(F.trim(raw))


def short_label(label: Column) -> Column:
    """Map a dividend label to its short name; unknown labels pass through."""
    mapping = F.create_map(*[F.lit(x) for kv in TYPE_SHORT.items() for x in kv])
    return F.coalesce(F.element_at(mapping, label), label)
