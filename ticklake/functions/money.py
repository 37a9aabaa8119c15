"""Money expressions: exact decimals in, exact decimals (or their text) out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklake.schemas import JCP_LABEL, JCP_WITHHOLDING, PRICE, RATE, WIDE

# Plain decimal literal with optional sign and exponent, surrounding blanks allowed.
_DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _fits(text: Column, wide: Column, narrow: Column, target) -> Column:
    """Whether a number's text loses nothing at the target's scale: its decimals less
    trailing zeros are counted (a text with an exponent is compared by value). Most texts have
    no more characters behind the point than that."""
    dot = F.instr(text, ".")
    short = (dot == 0) | (F.length(text) - dot <= target.scale)
    decimals = F.length(F.regexp_extract(F.trim(text), r"\.(\d*?)0*$", 1))
    return (narrow == wide) & (short | text.rlike("[eE]") | (decimals <= target.scale))


def _exact(text: Column, target) -> Column:
    """Cast text to ``target`` only when that loses nothing; NULL otherwise."""
    wide = F.when(text.rlike(_DECIMAL_TEXT), F.trim(text).try_cast(WIDE))
    narrow = wide.try_cast(target)
    return F.when(_fits(text, wide, narrow, target), narrow)


def exact_price(text: Column) -> Column:
    """An event's price text as PRICE; NULL when that would round it, as the line parser
    dead-letters the same text."""
    return _exact(text, PRICE)


def comma_decimal(text: Column, target=PRICE) -> Column:
    """'41,200' -> 41.200. NULL when not a number or when it needs more scale than ``target``."""
    return _exact(F.replace(text, F.lit(","), F.lit(".")), target)


def comma_decimal_is_lossy(text: Column, target=PRICE) -> Column:
    """True when the text is a valid number whose scale does not fit ``target``."""
    t = F.trim(F.replace(text, F.lit(","), F.lit(".")))
    wide = F.when(t.rlike(_DECIMAL_TEXT), t.try_cast(WIDE))
    narrow = wide.try_cast(target)
    return wide.isNotNull() & ~F.coalesce(_fits(t, wide, narrow, target), F.lit(False))


def ptbr_decimal(text: Column, target=RATE) -> Column:
    """pt-BR number: dot groups thousands, comma is the decimal mark ('4.900,000' -> 4900)."""
    plain = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return _exact(plain, target)


def money_text(value: Column) -> Column:
    """Decimal -> its text at the column's scale ('41.200'); NULL stays NULL."""
    return value.cast("string")


def jcp_net(rate: Column) -> Column:
    """Net per share of a JCP payment: gross minus the withholding (scale grows to 13)."""
    return rate * (F.lit(1) - F.lit(JCP_WITHHOLDING).cast("decimal(2,2)"))


def net_per_share_text(label: Column, rate: Column) -> Column:
    """Net text per branch: JCP carries 13 decimals, other labels repeat the gross text."""
    return F.when(label == JCP_LABEL, money_text(jcp_net(rate))).otherwise(money_text(rate))


def net_per_share(label: Column, rate: Column) -> Column:
    """Numeric net per share (one common decimal type for both branches)."""
    return F.when(label == JCP_LABEL, jcp_net(rate)).otherwise(rate)


def yield_on_price(gross: Column, price: Column) -> Column:
    """round(gross / price, 6) as a double; NULL when the price is 0 or NULL."""
    return F.round(F.try_divide(gross, price).cast("double"), 6)
