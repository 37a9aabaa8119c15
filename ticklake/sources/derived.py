"""Market inputs derived from the driver tables (mapping documented in FIXTURES.md).

The driver ships TPC-H-like tables; these scans re-read them as the inputs the engine
serves: trade events (from lineitem), raw trade lines with injected faults, dividend
reference data and supplement documents (from orders), a cursor log (from events),
a tracked-ticker dimension (from supplier) and ticker lookups (from customer).
Everything is a narrow projection of one scan: no shuffle, no driver round trip.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.timefmt import br_date_text
from ticklake.schemas import PRICE, RATE, SCHEMA_VERSION, SOURCE_EOD
from ticklake.sources.tables import table

N_TICKERS = 20
_TRADE_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority")


def tk(key: Column) -> Column:
    """'TK' + two-digit bucket of a key."""
    return F.concat(F.lit("TK"), F.lpad((key % N_TICKERS).cast("string"), 2, "0"))


def _month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def trade_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trade event per lineitem row (the decoded event log, ``trades_raw``).

    (l_orderkey, l_linenumber) repeats, so re-deliveries with different values exist.
    """
    li = table(spark, sf_dir, "lineitem", *_TRADE_COLS, parallel=True)
    trade_date = _month_start(F.col("l_shipdate"))
    return li.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        tk(F.col("l_suppkey")).alias("ticker"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        F.when(F.col("l_returnflag") == "R", F.lit(2)).otherwise(F.lit(0)).alias("action"),
        F.col("l_extendedprice").cast(PRICE).cast("string").alias("price"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber")))
        .alias("traded_at"),
        trade_date.alias("trade_date"),
        F.date_add(trade_date, F.col("l_linenumber") % 2).alias("reference_date"),
        F.when(F.col("l_linestatus") == "O", F.lit(6)).otherwise(F.lit(1)).alias("session_type"),
        F.lit(SOURCE_EOD).alias("source"),
    )


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ';'-separated trade lines, one per lineitem row, with the file they landed in.

    Injected faults: l_orderkey % 101 = 0 drops field 0, % 103 = 0 garbles the price,
    % 107 = 0 truncates the time field.
    """
    li = table(spark, sf_dir, "lineitem", *_TRADE_COLS, parallel=True)
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    trade_date = _month_start(F.col("l_shipdate"))
    session_date = F.date_add(trade_date, ln % 2)
    ticker = tk(sk)
    clock = F.concat(F.lpad((ln + 10).cast("string"), 2, "0"),
                     F.lpad((ok % 60).cast("string"), 2, "0"),
                     F.lpad((pk % 60).cast("string"), 2, "0"),
                     F.lpad((pk % 1000).cast("string"), 3, "0"))
    price = F.replace(F.col("l_extendedprice").cast(PRICE).cast("string"), F.lit("."), F.lit(","))
    fields = [
        F.when(ok % 101 != 0, session_date.cast("string")),
        ticker,
        F.when(F.col("l_returnflag") == "R", F.lit("2")).otherwise(F.lit("0")),
        F.when(ok % 103 == 0, F.lit("not-a-price")).otherwise(price),
        F.col("l_quantity").cast("bigint").cast("string"),
        F.when(ok % 107 == 0, F.lit("1007")).otherwise(clock),
        (ok * 10 + ln).cast("string"),
        F.when(F.col("l_linestatus") == "O", F.lit("6")).otherwise(F.lit("1")),
        trade_date.cast("string"),
        (pk % 100).cast("string"),
        F.when(sk % 7 == 0, F.lit("")).otherwise((sk % 1000).cast("string")),
    ]
    return li.select(
        ticker.alias("file_ticker"),
        session_date.alias("session_date"),
        F.concat(F.date_format(session_date, "dd-MM-yyyy"), F.lit("_NEGOCIOSAVISTA_"), ticker,
                 F.lit(".txt")).alias("filename"),
        F.lit(SOURCE_EOD).alias("source"),
        (ok * 10 + ln).alias("line_no"),
        F.concat_ws(";", *fields).alias("raw_line"),
    )


def _dividend_ticker() -> Column:
    return tk(F.col("o_custkey"))


def _label() -> Column:
    return (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("JRS CAP PROPRIO"))
             .when(F.col("o_orderpriority") == "2-HIGH", F.lit("RENDIMENTO"))
             .otherwise(F.lit("DIVIDENDO")))


def _rate() -> Column:
    return (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(Decimal("0.01"))).cast(RATE)


def _isin(ticker: Column) -> Column:
    """'BR' + ticker root + class code + check digit. The class follows the order key, so
    some rows carry the other share class and are dropped by the class filter."""
    klass = F.when(F.col("o_orderkey") % 2 == 0, F.lit("ACNOR")).otherwise(F.lit("ACNPR"))
    return F.concat(F.lit("BR"), F.substring(ticker, 1, 3), klass,
                    (F.col("o_orderkey") % 10).cast("string"))


def cash_dividends(spark: SparkSession, sf_dir: str, synced_at: str) -> DataFrame:
    """Stored ``cash_dividends`` table: one announced cash payment per order."""
    o = table(spark, sf_dir, "orders")
    d = F.to_date(F.col("o_orderdate"))
    ticker = _dividend_ticker()
    return o.select(
        ticker.alias("ticker"),
        _isin(ticker).alias("isin"),
        _label().alias("label"),
        _rate().alias("rate"),
        d.alias("approved_on"),
        F.date_add(d, 10).alias("last_date_prior"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("date"))
         .otherwise(F.date_add(d, 60)).alias("payment_date"),
        F.concat(F.lit("Anual/"), F.year(d).cast("string")).alias("related_to"),
        F.lit(synced_at).cast("timestamp_ntz").alias("synced_at"),
    )


def _stock_label() -> Column:
    return (F.when(F.col("o_orderkey") % 3 == 0, F.lit("DESDOBRAMENTO"))
             .when(F.col("o_orderkey") % 3 == 1, F.lit("GRUPAMENTO"))
             .otherwise(F.lit("BONIFICACAO")))


def _factor() -> Column:
    return (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(Decimal("0.1"))).cast(RATE)


def stock_dividends(spark: SparkSession, sf_dir: str, synced_at: str) -> DataFrame:
    """Stored ``stock_dividends``: a split/grouping/bonus for every order."""
    o = table(spark, sf_dir, "orders")
    d = F.to_date(F.col("o_orderdate"))
    ticker = _dividend_ticker()
    return o.select(
        ticker.alias("ticker"),
        _isin(ticker).alias("isin"),
        _stock_label().alias("label"),
        _factor().alias("factor"),
        d.alias("approved_on"),
        F.date_add(d, 10).alias("last_date_prior"),
        F.lit(synced_at).cast("timestamp_ntz").alias("synced_at"),
    )


def _ptbr(value: Column, scale: int) -> Column:
    """Decimal -> pt-BR text with thousands dots and a decimal comma ('4.900,00000000000')."""
    us = F.format_number(value, scale)  # '4,900.00000000000'
    return F.translate(us, ",.", ".,")


def supplement_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed corporate-action supplement documents, one per order, as JSON text.

    Even order keys are wrapped in a one-element list; order keys divisible by 13 carry
    an extra malformed cash row; pending orders use the 'to be defined' payment date;
    low-priority orders also carry a stock dividend whose factor uses thousands dots.
    """
    o = table(spark, sf_dir, "orders", *_ORDER_COLS, parallel=True)
    d = F.to_date(F.col("o_orderdate"))
    ticker = _dividend_ticker()
    cash = F.struct(
        _isin(ticker).alias("assetIssued"),
        F.when(F.col("o_orderstatus") == "P", F.lit("31/12/9999"))
         .otherwise(br_date_text(F.date_add(d, 60))).alias("paymentDate"),
        _ptbr(_rate(), 11).alias("rate"),
        F.concat(F.lit("Anual/"), F.year(d).cast("string")).alias("relatedTo"),
        br_date_text(d).alias("approvedOn"),
        _isin(ticker).alias("isinCode"),
        _label().alias("label"),
        br_date_text(F.date_add(d, 10)).alias("lastDatePrior"),
        F.lit("").alias("remarks"),
    )
    cash_json = F.to_json(cash)
    bad_json = F.lit('{"garbage":true}')
    cash_list = F.when(F.col("o_orderkey") % 13 == 0,
                       F.concat(F.lit("["), cash_json, F.lit(","), bad_json, F.lit("]"))) \
                 .otherwise(F.concat(F.lit("["), cash_json, F.lit("]")))
    stock = F.struct(
        _isin(ticker).alias("assetIssued"),
        _ptbr(_factor(), 11).alias("factor"),
        br_date_text(d).alias("approvedOn"),
        _isin(ticker).alias("isinCode"),
        _stock_label().alias("label"),
        br_date_text(F.date_add(d, 10)).alias("lastDatePrior"),
        F.lit("").alias("remarks"),
    )
    stock_list = F.when(F.col("o_orderpriority") == "5-LOW",
                        F.concat(F.lit("["), F.to_json(stock), F.lit("]"))).otherwise(F.lit("null"))
    doc = F.concat(F.lit('{"cashDividends":'), cash_list, F.lit(',"stockDividends":'), stock_list,
                   F.lit("}"))
    wrapped = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("["), doc, F.lit("]"))).otherwise(doc)
    return o.select(
        F.concat(F.lit("CO"), F.lpad((F.col("o_custkey") % N_TICKERS).cast("string"), 2, "0"))
         .alias("issuing_company"),
        F.col("o_orderkey").alias("doc_id"),
        wrapped.alias("body"),
    )


def tracked_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked-ticker dimension for the derived market: one row per ticker bucket, named
    after the lowest supplier in it. Bounded by N_TICKERS rows."""
    s = table(spark, sf_dir, "supplier")
    bucket = F.col("s_suppkey") % N_TICKERS
    return (s.groupBy(bucket.alias("b"))
             .agg(F.min_by("s_name", "s_suppkey").alias("company"))
             .select(tk(F.col("b")).alias("ticker"), "company",
                     F.concat(F.lit("CO"), F.lpad(F.col("b").cast("string"), 2, "0"))
                      .alias("issuing_company"),
                     F.upper(F.col("company")).alias("trading_name")))


def ticker_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker lookups as typed by users: mixed case and stray blanks; buckets 20-24 are
    not traded."""
    c = table(spark, sf_dir, "customer")
    raw = F.concat(F.lit("TK"), F.lpad((F.col("c_custkey") % 25).cast("string"), 2, "0"))
    typed = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), F.lower(raw), F.lit(" "))) \
             .otherwise(raw)
    return c.select(F.col("c_custkey").alias("request_id"), typed.alias("requested"))


def cursor_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compacted cursor topic replayed from ``events``: key per user, a JSON value, NULL
    (tombstone) for error events, partition = key bucket, offset = event id."""
    e = table(spark, sf_dir, "events")
    value = F.concat(F.lit('{"max_trade_id": '), F.get_json_object("props", "$.k"), F.lit("}"))
    return e.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("key"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string")).otherwise(value)
         .alias("value"),
        (F.col("user_id") % 12).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


def raw_event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-log values for the lenient decoder: ``events.props`` with injected non-JSON,
    array-shaped and wrong-typed payloads."""
    e = table(spark, sf_dir, "events")
    m = F.col("event_id") % 50
    value = (F.when(m == 0, F.lit("not json"))
              .when(m == 1, F.lit("[1,2]"))
              .when(m == 2, F.lit('{"k":"abc"}'))
              .when(m == 3, F.lit('{"foo":1}'))
              .otherwise(F.col("props")))
    return e.select("event_id", value.alias("value"))


def download_manifest(lines: DataFrame) -> DataFrame:
    """Landing manifest per trade file (ticker, session): HTTP answer and body size.

    Status rules: day-2 sessions of months divisible by 4 -> 404; TK07 in odd months ->
    403; TK13 in December -> 503; TK05 on day 1 of quarter-end months -> 200 without a
    content-disposition; TK11 in January and February -> 200 with an empty body.
    """
    files = lines.groupBy(F.col("file_ticker").alias("ticker"), "session_date").agg(
        F.sum(F.length("raw_line") + 1).cast("bigint").alias("body_bytes"))
    day = F.dayofmonth("session_date")
    month = F.month("session_date")
    ticker = F.col("ticker")
    status = (F.when((month % 4 == 0) & (day == 2), F.lit(404))
               .when((ticker == "TK07") & (month % 2 == 1), F.lit(403))
               .when((ticker == "TK13") & (month == 12), F.lit(503))
               .otherwise(F.lit(200)))
    no_header = (ticker == "TK05") & (day == 1) & (month % 3 == 0)
    empty = (ticker == "TK11") & (month <= 2)
    return files.select(
        "ticker", "session_date",
        status.alias("http_status"),
        (~no_header).alias("has_content_disposition"),
        F.when((status == 200) & ~empty, F.col("body_bytes")).otherwise(F.lit(0).cast("bigint"))
         .alias("content_length"),
    )
