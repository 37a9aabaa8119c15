"""Corporate actions: supplement parsing, share-class filter, dedup, status and the
pending-dividend question ("announced, unpaid, can I still buy in time?")."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.money import money_text, net_per_share, net_per_share_text, ptbr_decimal, yield_on_price
from ticklake.functions.text import normalize_ticker
from ticklake.functions.timefmt import (
    br_date, br_payment_date, iso_instant, local_date, utc_literal,
)
from ticklake.schemas import (
    CLASS_CODES, EXEMPT_TAX_NOTE, JCP_LABEL, JCP_TAX_NOTE, PAYMENT_TBD_SENTINEL, RATE,
    STATUS_PAID, STATUS_PENDING_PAYMENT, STATUS_WITH_RIGHTS, SUPPLEMENT_JSON,
)

CASH_COLUMNS = ["ticker", "isin", "label", "rate", "approved_on", "last_date_prior",
                "payment_date", "related_to"]
STOCK_COLUMNS = ["ticker", "isin", "label", "factor", "approved_on", "last_date_prior"]
_CASH_REQUIRED = ["isinCode", "label", "rate", "approvedOn", "lastDatePrior", "paymentDate"]
_STOCK_REQUIRED = ["isinCode", "label", "factor", "approvedOn", "lastDatePrior"]


# --------------------------------------------------------------------------- S7

def unwrap_supplement(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """Decode a landed supplement body (an object, or a list whose first element is
    the object) into ``cash``/``stock`` arrays of string maps plus ``doc_error``.

    Empty body, non-JSON and an empty supplement are errors (the previous rows of that
    issuer are then left untouched by the replace sink). Missing or null arrays = empty.
    """
    keep = [c for c in docs.columns if c != body_col]
    # Single-row generators act as evaluation barriers (see ``parse.parse_lines``): the
    # body is trimmed once and each JSON function reads the attribute, and a filter on
    # ``doc_error`` is not pushed below the decode by re-inlining it.
    trimmed = docs.select(*keep, F.explode(F.array(F.trim(F.col(body_col)))).alias("_body"))
    body = F.col("_body")
    first = F.when(F.startswith(body, F.lit("[")), F.get_json_object(body, "$[0]")).otherwise(body)
    # One parse serves both shapes: with an array-of-struct schema Spark wraps a single
    # object as a one-element array. Invalid JSON (or a non-object element) gives NULL.
    read = trimmed.select(*keep, "_body", F.inline(F.array(F.struct(
        F.from_json(body, T.ArrayType(SUPPLEMENT_JSON)).alias("_docs"), first.alias("_first")))))
    docs_arr, first = F.col("_docs"), F.col("_first")
    doc = F.get(docs_arr, 0)
    # Decided by the parsed value: an object without keys is empty whatever its length, and
    # text after the document or an array that is no array makes the whole document an error.
    whole = body.rlike(r"(?s)^(\{.*\}|\[.*\])$") & F.try_parse_json(body).isNotNull()
    no_keys = F.coalesce(F.size(F.json_object_keys(first)) == 0, F.lit(False))

    def no_list(name: str) -> Column:
        value = F.get_json_object(first, f"$.{name}")
        return F.coalesce(~F.startswith(value, F.lit("[")), F.lit(False))

    error = (F.when(body.isNull() | (F.length(body) == 0), F.lit("empty body"))
              .when(docs_arr.isNull() | ~F.coalesce(whole, F.lit(False)), F.lit("non-JSON body"))
              .when((F.size(docs_arr) == 0) | no_keys, F.lit("empty supplement"))
              .when(no_list("cashDividends") | no_list("stockDividends"), F.lit("malformed supplement")))
    decoded = F.struct(
        F.coalesce(doc["cashDividends"], F.array()).alias("cash"),
        F.coalesce(doc["stockDividends"], F.array()).alias("stock"),
        error.alias("doc_error"))
    return read.select(*keep, F.inline(F.array(decoded)))


def _missing(row: Column, keys: list[str]) -> Column:
    missing = [F.when(~F.map_contains_key(row, k), F.lit(k)) for k in keys]
    return F.concat_ws(",", *missing)


def _row_error(kind: str, missing: Column, name: str, amount: Column, approved: Column, last: Column) -> Column:
    """The first problem of a row of ``kind``, whose amount is called ``name``."""
    bad = f"bad {kind} dividend row: "
    return (F.when(missing != "", F.concat(F.lit(f"{bad}missing "), missing))
             .when(amount.isNull(), F.lit(f"{bad}{name}"))
             .when(approved.isNull(), F.lit(f"{bad}approvedOn"))
             .when(last.isNull(), F.lit(f"{bad}lastDatePrior")))


def _cash_error(missing: Column, rate: Column, approved: Column, last: Column, payment: Column, payment_text: Column) -> Column:
    return _row_error("cash", missing, "rate", rate, approved, last).when(
        payment.isNull() & (payment_text != PAYMENT_TBD_SENTINEL), F.lit("bad cash dividend row: paymentDate"))


def parse_cash_rows(unwrapped: DataFrame) -> DataFrame:
    """Explode cash rows and type them; ``row_error`` names the first problem."""
    keep = [c for c in unwrapped.columns if c not in ("cash", "stock", "doc_error")]
    rows = (unwrapped.filter(F.col("doc_error").isNull())
            .select(*keep, F.posexplode("cash").alias("row_no", "r")))
    r = F.col("r")
    rate = ptbr_decimal(r["rate"], RATE)
    approved = br_date(r["approvedOn"])
    last = br_date(r["lastDatePrior"])
    payment = br_payment_date(r["paymentDate"], PAYMENT_TBD_SENTINEL)
    error = _cash_error(_missing(r, _CASH_REQUIRED), rate, approved, last, payment, r["paymentDate"])
    return rows.select(
        *keep, "row_no",
        r["isinCode"].alias("isin"), r["label"].alias("label"), rate.alias("rate"),
        approved.alias("approved_on"), last.alias("last_date_prior"),
        payment.alias("payment_date"),
        F.when(F.map_contains_key(r, "relatedTo"), r["relatedTo"]).otherwise(F.lit(""))
         .alias("related_to"),
        error.alias("row_error"),
    )


def parse_stock_rows(unwrapped: DataFrame) -> DataFrame:
    keep = [c for c in unwrapped.columns if c not in ("cash", "stock", "doc_error")]
    rows = (unwrapped.filter(F.col("doc_error").isNull())
            .select(*keep, F.posexplode("stock").alias("row_no", "r")))
    r = F.col("r")
    factor = ptbr_decimal(r["factor"], RATE)
    approved = br_date(r["approvedOn"])
    last = br_date(r["lastDatePrior"])
    error = _row_error("stock", _missing(r, _STOCK_REQUIRED), "factor", factor, approved, last)
    return rows.select(
        *keep, "row_no",
        r["isinCode"].alias("isin"), r["label"].alias("label"), factor.alias("factor"),
        approved.alias("approved_on"), last.alias("last_date_prior"),
        error.alias("row_error"),
    )


# --------------------------------------------------------------------------- J4, P8, D1

def issuer_tickers(watchlist: DataFrame) -> DataFrame:
    """Issuing company -> ticker; on a duplicated issuer the later entry wins."""
    if "position" not in watchlist.columns:
        watchlist = watchlist.withColumn("position", F.lit(0))
    return (watchlist.groupBy("issuing_company")
            .agg(F.max_by("ticker", "position").alias("ticker")))


def isin_matches_ticker(isin: Column, ticker: Column) -> Column:
    """ISIN = 'BR' + ticker root + class code (3 -> ACNOR, 4 -> ACNPR) + check digit.
    Other class digits never match."""
    codes = F.create_map(*[F.lit(x) for kv in CLASS_CODES.items() for x in kv])
    root = F.substring(ticker, F.lit(1), F.length(ticker) - 1)
    code = F.element_at(codes, F.substring(ticker, -1, 1))
    return F.coalesce(F.startswith(isin, F.concat(F.lit("BR"), root, code)), F.lit(False))


def for_tracked(rows: DataFrame, watchlist: DataFrame, columns: list[str]) -> DataFrame:
    """Attach the tracked ticker (equi join on issuer), keep the matching share class,
    drop exact duplicate rows (NULL equals NULL)."""
    issuers = F.broadcast(issuer_tickers(watchlist))  # bounded: one row per tracked issuer
    return (rows.filter(F.col("row_error").isNull())
            .join(issuers, "issuing_company")
            .filter(isin_matches_ticker(F.col("isin"), F.col("ticker")))
            .select(*columns)
            .dropDuplicates(columns))


def supplement_errors(unwrapped: DataFrame) -> DataFrame:
    """Every document- or row-level problem, one row each (nothing is dropped silently). One pass:
    a document gives itself if it is an error, else its cash and stock rows."""
    keep = [c for c in unwrapped.columns if c not in ("cash", "stock", "doc_error")]

    def rows_of(name: str) -> Column:
        return F.transform(F.col(name), lambda r, i: F.struct(F.lit(name).alias("kind"), i.alias("row_no"), r.alias("r")))

    none = unwrapped.schema["cash"].dataType.elementType
    whole = F.array(F.struct(F.lit("doc").alias("kind"), F.lit(None).cast("int").alias("row_no"), F.lit(None).cast(none).alias("r")))
    parts = F.when(F.col("doc_error").isNotNull(), whole).otherwise(F.concat(rows_of("cash"), rows_of("stock")))
    rows = unwrapped.select(*keep, "doc_error", F.inline(parts))
    c, r, cash = F.col, F.col("r"), F.col("kind") == "cash"
    # typed first, and the error behind a barrier: each field is read once per row
    typed = rows.select(
        *keep, "doc_error", "kind", "row_no",
        F.when(cash, _missing(r, _CASH_REQUIRED)).otherwise(_missing(r, _STOCK_REQUIRED)).alias("_missing"),
        ptbr_decimal(F.when(cash, r["rate"]).otherwise(r["factor"]), RATE).alias("_amount"),
        br_date(r["approvedOn"]).alias("_approved"), br_date(r["lastDatePrior"]).alias("_last"),
        br_payment_date(r["paymentDate"], PAYMENT_TBD_SENTINEL).alias("_payment"), r["paymentDate"].alias("_payment_text"))
    error = (F.when(c("kind") == "doc", c("doc_error"))
              .when(cash, _cash_error(c("_missing"), c("_amount"), c("_approved"), c("_last"), c("_payment"), c("_payment_text")))
              .otherwise(_row_error("stock", c("_missing"), "factor", c("_amount"), c("_approved"), c("_last"))))
    return typed.select(*keep, "row_no", F.explode(F.array(error)).alias("error")).filter(c("error").isNotNull())


# --------------------------------------------------------------------------- F10, F11

def market_today(as_of) -> Column:
    """the market-zone calendar date of the clock parameter."""
    return local_date(utc_literal(as_of))


def status_sql(last_date_prior: Column, today: Column) -> Column:
    """two-state status used by the pending query (paid rows are filtered first)."""
    return F.when(today <= last_date_prior, F.lit(STATUS_WITH_RIGHTS)).otherwise(
        F.lit(STATUS_PENDING_PAYMENT))


def status_full(last_date_prior: Column, payment_date: Column, today: Column) -> Column:
    """three states; says with_rights while today <= last_date_prior even if paid."""
    return (F.when(today <= last_date_prior, F.lit(STATUS_WITH_RIGHTS))
             .when(payment_date.isNull() | (payment_date > today), F.lit(STATUS_PENDING_PAYMENT))
             .otherwise(F.lit(STATUS_PAID)))


def is_pending(payment_date: Column, today: Column) -> Column:
    """P5: unpaid = no payment date yet, or paid strictly after today."""
    return payment_date.isNull() | (payment_date > today)


# --------------------------------------------------------------------------- pending

def pending(cash: DataFrame, last_price: DataFrame, as_of, ticker: str | None = None,
            ordered: bool = True) -> DataFrame:
    """The flagship question: cash dividends not yet paid, joined with the latest price.

    Inner join: dividends of a ticker without a price are dropped. ``last_price`` has one
    row per ticker; AQE broadcasts it when its measured size is under the threshold and
    keeps a shuffle join otherwise. An optional ticker (trimmed, upper-cased) is a filter
    that Catalyst pushes into both scans.
    """
    today = market_today(as_of)
    d = cash.filter(is_pending(F.col("payment_date"), today))
    if ticker is not None:
        d = d.filter(F.col("ticker") == normalize_ticker(F.lit(ticker)))
    j = d.join(last_price.select("ticker", "price", "traded_at"), "ticker")
    if ordered:
        j = j.orderBy("ticker", F.asc_nulls_last("payment_date"))
    return shape_pending(j, today)


def pending_numeric(cash: DataFrame, last_price: DataFrame, as_of) -> DataFrame:
    """Pending rows with numeric money (for aggregates such as the radar)."""
    today = market_today(as_of)
    d = cash.filter(is_pending(F.col("payment_date"), today))
    return d.join(last_price.select("ticker", "price", "traded_at"), "ticker").select(
        "ticker", "label", "rate", net_per_share(F.col("label"), F.col("rate")).alias("net"),
        "payment_date", "last_date_prior", "price", "traded_at",
        status_sql(F.col("last_date_prior"), today).alias("status"))


def shape_pending(rows: DataFrame, today: Column) -> DataFrame:
    """P10: public row shape; money as text at its own scale, dates ISO, instants UTC."""
    label, rate = F.col("label"), F.col("rate")
    return rows.select(
        "ticker",
        label.alias("type"),
        status_sql(F.col("last_date_prior"), today).alias("status"),
        money_text(rate).alias("gross_per_share"),
        net_per_share_text(label, rate).alias("net_per_share"),
        F.when(label == JCP_LABEL, F.lit(JCP_TAX_NOTE)).otherwise(F.lit(EXEMPT_TAX_NOTE))
         .alias("tax_note"),
        F.col("approved_on").cast("string").alias("approved_on"),
        F.col("last_date_prior").cast("string").alias("buy_by"),
        F.col("payment_date").cast("string").alias("payment_date"),
        F.col("payment_date").isNull().alias("payment_tbd"),
        yield_on_price(rate, F.col("price")).alias("yield_on_last_price"),
        money_text(F.col("price")).alias("last_price"),
        iso_instant(F.col("traded_at")).alias("price_as_of"),
    )


def statuses(cash: DataFrame, as_of) -> DataFrame:
    """F10 and F11 side by side for every stored cash dividend."""
    today = market_today(as_of)
    return cash.select(
        "ticker", "isin", "label", "approved_on", "last_date_prior", "payment_date",
        is_pending(F.col("payment_date"), today).alias("pending"),
        status_sql(F.col("last_date_prior"), today).alias("status_sql"),
        status_full(F.col("last_date_prior"), F.col("payment_date"), today).alias("status"),
    )
