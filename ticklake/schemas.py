"""Types, schemas and fixed values.

Nothing is inferred: every source is read with one of the StructTypes below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Money. Prices are published with 3 decimals, dividend rates / split factors with 11.
PRICE = T.DecimalType(18, 3)
RATE = T.DecimalType(20, 11)
# Wide decimal used for the lossless-scale check of parsed prices.
WIDE = T.DecimalType(38, 18)
VOLUME = T.DecimalType(38, 3)

# ---------------------------------------------------------------------------
# These must equal the source system's constants for results to match.
# ---------------------------------------------------------------------------
MARKET_ZONE = "America/Sao_Paulo"
SCHEMA_VERSION = 1
ACTION_NEW = 0
ACTION_CANCELLED = 2
SESSION_REGULAR = 1
SESSION_AFTER_MARKET = 6
SOURCE_INTRADAY = "intraday_poll"
SOURCE_EOD = "eod_file"
TRADE_LINE_FIELDS = 11
PAYMENT_TBD_SENTINEL = "31/12/9999"
STATUS_WITH_RIGHTS = "with_rights"
STATUS_PENDING_PAYMENT = "pending_payment"
STATUS_PAID = "paid"
JCP_LABEL = "JRS CAP PROPRIO"
JCP_WITHHOLDING = "0.15"
JCP_TAX_NOTE = "JCP: 15% IRRF withheld at source; published rate is gross"
EXEMPT_TAX_NOTE = "dividends currently exempt from IRRF for individuals"
# ISIN class codes by the ticker's last digit: 3 = ON, 4 = PN. Other digits never match.
CLASS_CODES = {"3": "ACNOR", "4": "ACNPR"}
# Short labels used by the dividend radar.
TYPE_SHORT = {"JRS CAP PROPRIO": "JCP", "DIVIDENDO": "Dividendo", "RENDIMENTO": "Rendimento"}
# Market window in Sao Paulo wall-clock time, inclusive at both ends.
WINDOW_START = "09:55:00"
WINDOW_END = "18:35:00"
TRADES_MAX_AGE_SECONDS = 30 * 60
CORPORATE_ACTIONS_MAX_AGE_SECONDS = 7 * 3600
BACKFILL_CALENDAR_DAYS = 28
CHAIN_NOTE = "freshness here proves the whole chain: landed files -> event log -> gold tables"
UNKNOWN_TICKER_ERROR = "ticker {} is not tracked"
# Tracked companies: ticker, company, issuing company, trading name.
WATCHLIST = (
    ("ABEV3", "Ambev", "ABEV", "AMBEV S/A"),
    ("B3SA3", "B3", "B3SA", "B3"),
    ("BBAS3", "Banco do Brasil", "BBAS", "BRASIL"),
    ("BBDC4", "Banco Bradesco", "BBDC", "BRADESCO"),
    ("ITSA4", "Itaúsa", "ITSA", "ITAUSA"),
    ("ITUB4", "Itaú Unibanco", "ITUB", "ITAUUNIBANCO"),
    ("MGLU3", "Magazine Luiza", "MGLU", "MAGAZ LUIZA"),
    ("PETR4", "Petrobras", "PETR", "PETROBRAS"),
    ("VALE3", "Vale", "VALE", "VALE"),
    ("WEGE3", "WEG", "WEGE", "WEG"),
)
# ---------------------------------------------------------------------------

WATCHLIST_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("company", T.StringType(), False),
    T.StructField("issuing_company", T.StringType(), False),
    T.StructField("trading_name", T.StringType(), False),
])

# Trade event as it travels in the event log (price is text so no float touches money).
TRADE_EVENT_SCHEMA = T.StructType([
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("action", T.IntegerType()),
    T.StructField("price", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("traded_at", T.TimestampType()),
    T.StructField("trade_date", T.DateType()),
    T.StructField("reference_date", T.DateType()),
    T.StructField("session_type", T.IntegerType()),
    T.StructField("source", T.StringType()),
])

# Decoded, typed event row (bronze). traded_at is a UTC wall clock without zone.
TRADE_EVENT_COLUMNS = [f.name for f in TRADE_EVENT_SCHEMA.fields]

TRADE_COLUMNS = ["ticker", "trade_id", "action", "price", "quantity", "traded_at",
                 "trade_date", "reference_date", "session_type"]

DEAD_LETTER_COLUMNS = ["schema_version", "ticker", "session_date", "filename", "source",
                       "error", "raw_line"]

CASH_DIVIDEND_JSON = T.StructType([
    T.StructField("assetIssued", T.StringType()),
    T.StructField("paymentDate", T.StringType()),
    T.StructField("rate", T.StringType()),
    T.StructField("relatedTo", T.StringType()),
    T.StructField("approvedOn", T.StringType()),
    T.StructField("isinCode", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("lastDatePrior", T.StringType()),
    T.StructField("remarks", T.StringType()),
])
STOCK_DIVIDEND_JSON = T.StructType([
    T.StructField("assetIssued", T.StringType()),
    T.StructField("factor", T.StringType()),
    T.StructField("approvedOn", T.StringType()),
    T.StructField("isinCode", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("lastDatePrior", T.StringType()),
    T.StructField("remarks", T.StringType()),
])
SUPPLEMENT_JSON = T.StructType([
    T.StructField("cashDividends", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("stockDividends", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])

CASH_DIVIDENDS_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("isin", T.StringType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("rate", RATE, False),
    T.StructField("approved_on", T.DateType(), False),
    T.StructField("last_date_prior", T.DateType(), False),
    T.StructField("payment_date", T.DateType(), True),
    T.StructField("related_to", T.StringType(), False),
    T.StructField("synced_at", T.TimestampNTZType(), False),
])
STOCK_DIVIDENDS_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("isin", T.StringType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("factor", RATE, False),
    T.StructField("approved_on", T.DateType(), False),
    T.StructField("last_date_prior", T.DateType(), False),
    T.StructField("synced_at", T.TimestampNTZType(), False),
])

LAST_PRICE_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("price", PRICE, False),
    T.StructField("traded_at", T.TimestampNTZType(), False),
])
SESSION_SUMMARY_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("trade_date", T.DateType(), False),
    T.StructField("open", PRICE, True),
    T.StructField("high", PRICE, True),
    T.StructField("low", PRICE, True),
    T.StructField("close", PRICE, True),
    T.StructField("quantity", T.LongType(), True),
    T.StructField("financial_volume", VOLUME, True),
    T.StructField("trades", T.LongType(), True),
])

# Landing manifest for downloaded trade archives.
MANIFEST_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("session_date", T.DateType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("has_content_disposition", T.BooleanType()),
    T.StructField("content_length", T.LongType()),
])

# Storage contract checked by the constraint operator: NOT NULL columns and keys.
NOT_NULL = {
    "last_price": ["ticker", "price", "traded_at"],
    "session_summary": ["ticker", "trade_date"],
    "cash_dividends": ["ticker", "isin", "label", "rate", "approved_on", "last_date_prior",
                       "related_to", "synced_at"],
    "stock_dividends": ["ticker", "isin", "label", "factor", "approved_on", "last_date_prior",
                        "synced_at"],
}
KEYS = {"last_price": ["ticker"], "session_summary": ["ticker", "trade_date"],
        "tracked_tickers": ["ticker"]}
