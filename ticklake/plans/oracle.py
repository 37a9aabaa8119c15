"""DuckDB SQL for every catalogue query, written independently of the Spark code.

Base CTEs re-derive the market inputs from the driver tables exactly as
``ticklake.sources.derived`` documents them; each query then states the operator's
semantics in plain SQL (window functions, ordered first/last, CASE) so the Spark plan
is checked against a different formulation, not a transcription of itself.
"""

from __future__ import annotations

AS_OF = "2001-06-01 15:00:00"  # UTC instant; Sao Paulo date 2001-06-01 (a Friday)
SYNCED_AT = "2001-06-01 14:00:00"
PREV_AS_OF = "2001-05-31 15:00:00"

TK = "'TK' || lpad(CAST({k} % 20 AS VARCHAR), 2, '0')"

TRADES_RAW = f"""
trades_raw AS (
  SELECT 1 AS schema_version,
         {TK.format(k='l_suppkey')} AS ticker,
         l_orderkey * 10 + l_linenumber AS trade_id,
         CASE WHEN l_returnflag = 'R' THEN 2 ELSE 0 END AS "action",
         CAST(CAST(l_extendedprice AS DECIMAL(18,3)) AS VARCHAR) AS price,
         CAST(l_quantity AS BIGINT) AS quantity,
         l_shipdate + l_linenumber * INTERVAL 1 MINUTE AS traded_at,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
         CAST(date_trunc('month', l_shipdate) AS DATE) + CAST(l_linenumber % 2 AS INTEGER)
           AS reference_date,
         CASE WHEN l_linestatus = 'O' THEN 6 ELSE 1 END AS session_type,
         'eod_file' AS source
  FROM lineitem
)"""

TRADES_CLEAN = """
trades_clean AS (
  SELECT ticker, trade_date, trade_id,
         max(TRY_CAST(price AS DECIMAL(18,3))) AS price,
         max(quantity) AS quantity,
         max(session_type) AS session_type,
         max(traded_at) AS traded_at,
         max("action") = 2 AS cancelled
  FROM trades_raw
  WHERE ticker IS NOT NULL AND trade_date IS NOT NULL AND trade_id IS NOT NULL
  GROUP BY ticker, trade_date, trade_id
)"""

LAST_PRICE = """
last_price AS (
  SELECT newest.ticker, newest.price, newest.traded_at
  FROM (SELECT arg_max({'ticker': ticker, 'price': price, 'traded_at': traded_at},
                       {'t': coalesce(traded_at, TIMESTAMP 'infinity'), 'id': trade_id, 'd': trade_date})
                 AS newest
        FROM trades_clean WHERE NOT cancelled GROUP BY ticker)
)"""

SESSION_SUMMARY = """
live AS (
  SELECT *, {'t': coalesce(traded_at, TIMESTAMP 'infinity'), 'id': trade_id} AS nth
  FROM trades_clean WHERE NOT cancelled
),
regular AS (
  SELECT ticker, trade_date, min(price) AS low, max(price) AS high,
         arg_min({'p': price}, nth).p AS "open", arg_max({'p': price}, nth).p AS "close"
  FROM live WHERE session_type = 1 GROUP BY ALL
),
volume AS (
  SELECT ticker, trade_date, CAST(sum(quantity) AS BIGINT) AS quantity,
         CAST(sum(price * quantity) AS DECIMAL(38,3)) AS financial_volume, count(*) AS trades
  FROM live GROUP BY ALL
),
session_summary AS (
  SELECT ticker, trade_date, "open", high, low, "close", quantity, financial_volume, trades
  FROM volume LEFT JOIN regular USING (ticker, trade_date)
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


ORACLE: dict[str, str] = {
    "session_event_counts": with_ctes(TRADES_RAW, body="""
SELECT ticker, trade_date, count(*) AS events FROM trades_raw GROUP BY ticker, trade_date"""),
    "trades_clean": with_ctes(TRADES_RAW, TRADES_CLEAN, body="SELECT * FROM trades_clean"),
    "last_price": with_ctes(TRADES_RAW, TRADES_CLEAN, LAST_PRICE, body="SELECT * FROM last_price"),
    "session_summary": with_ctes(TRADES_RAW, TRADES_CLEAN, SESSION_SUMMARY,
                                 body="SELECT * FROM session_summary"),
}


def py_repr(x: str) -> str:
    """DuckDB expression for Python's repr of a printable string."""
    esc = f"replace({x}, '\\', '\\\\')"
    return (f"CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') "
            f"THEN '\"' || {esc} || '\"' "
            f"ELSE '''' || replace({esc}, '''', '\\''') || '''' END")


def iso_instant(x: str) -> str:
    frac = f"((epoch_us({x}) % 1000000) + 1000000) % 1000000"
    return (f"CASE WHEN {x} IS NOT NULL THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN {frac} <> 0 THEN '.' || lpad(CAST({frac} AS VARCHAR), 6, '0') ELSE '' END"
            f" || '+00:00' END")


TRADE_LINES = f"""
li AS (
  SELECT *, {TK.format(k='l_suppkey')} AS ticker,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS trade_date,
         CAST(date_trunc('month', l_shipdate) AS DATE) + CAST(l_linenumber % 2 AS INTEGER)
           AS session_date
  FROM lineitem
),
trade_lines AS (
  SELECT ticker, session_date,
         strftime(session_date, '%d-%m-%Y') || '_NEGOCIOSAVISTA_' || ticker || '.txt' AS filename,
         'eod_file' AS source,
         l_orderkey * 10 + l_linenumber AS line_no,
         concat_ws(';',
           CASE WHEN l_orderkey % 101 <> 0 THEN CAST(session_date AS VARCHAR) END,
           ticker,
           CASE WHEN l_returnflag = 'R' THEN '2' ELSE '0' END,
           CASE WHEN l_orderkey % 103 = 0 THEN 'not-a-price'
                ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(18,3)) AS VARCHAR), '.', ',') END,
           CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
           CASE WHEN l_orderkey % 107 = 0 THEN '1007'
                ELSE lpad(CAST(l_linenumber + 10 AS VARCHAR), 2, '0')
                  || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0')
                  || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0')
                  || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') END,
           CAST(l_orderkey * 10 + l_linenumber AS VARCHAR),
           CASE WHEN l_linestatus = 'O' THEN '6' ELSE '1' END,
           CAST(trade_date AS VARCHAR),
           CAST(l_partkey % 100 AS VARCHAR),
           CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE CAST(l_suppkey % 1000 AS VARCHAR) END
         ) AS raw_line
  FROM li
)"""


def _iso_date(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST({x} AS DATE) "
            f"WHEN regexp_full_match({x}, '\\d{{8}}') THEN CAST(TRY_STRPTIME({x}, '%Y%m%d') AS DATE) END")


def _int(x: str, t: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '\\s*[+-]?\\d+\\s*') THEN TRY_CAST(trim({x}) AS {t}) END"


PARSED_LINES = f"""
split_lines AS (
  SELECT *, string_split(raw_line, ';') AS f FROM trade_lines
),
fields AS (
  SELECT *, len(f) AS n,
         {_iso_date('f[9]')} AS p_trade_date,
         {_int('f[7]', 'BIGINT')} AS p_trade_id,
         {_int('f[3]', 'INTEGER')} AS p_action,
         replace(f[4], ',', '.') AS price_txt,
         {_int('f[5]', 'BIGINT')} AS p_quantity,
         f[6] AS clock,
         {_iso_date('f[1]')} AS p_reference_date,
         {_int('f[8]', 'INTEGER')} AS p_session_type
  FROM split_lines
),
typed AS (
  SELECT *,
    CASE WHEN regexp_full_match(price_txt, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')
          AND TRY_CAST(trim(price_txt) AS DECIMAL(38,18)) = TRY_CAST(trim(price_txt) AS DECIMAL(18,3))
         THEN TRY_CAST(trim(price_txt) AS DECIMAL(18,3)) END AS p_price,
    CASE WHEN regexp_full_match(clock, '\\d{{9}}')
          AND CAST(substr(clock, 1, 2) AS INT) < 24 AND CAST(substr(clock, 3, 2) AS INT) < 60
          AND CAST(substr(clock, 5, 2) AS INT) < 60 AND p_trade_date IS NOT NULL
         THEN timezone('UTC', timezone('America/Sao_Paulo',
                CAST(p_trade_date AS TIMESTAMP) + to_microseconds(
                  CAST(substr(clock, 1, 2) AS BIGINT) * 3600000000
                + CAST(substr(clock, 3, 2) AS BIGINT) * 60000000
                + CAST(substr(clock, 5, 2) AS BIGINT) * 1000000
                + CAST(substr(clock, 7, 3) AS BIGINT) * 1000)))
    END AS p_traded_at
  FROM fields
),
parsed AS (
  SELECT ticker AS file_ticker, session_date, filename, source, line_no, raw_line,
         f[2] AS ticker, p_trade_id AS trade_id, p_action AS "action", p_price AS price,
         p_quantity AS quantity, p_traded_at AS traded_at, p_trade_date AS trade_date,
         p_reference_date AS reference_date, p_session_type AS session_type,
         CASE WHEN n <> 11 THEN 'expected 11 fields, got ' || CAST(n AS VARCHAR) || ': ' || {py_repr('raw_line')}
              ELSE CASE WHEN p_trade_date IS NULL THEN 'bad_trade_date'
                        WHEN p_trade_id IS NULL THEN 'bad_trade_id'
                        WHEN p_action IS NULL THEN 'bad_action'
                        WHEN p_price IS NULL AND TRY_CAST(trim(price_txt) AS DECIMAL(38,18)) IS NOT NULL
                             AND regexp_full_match(price_txt, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')
                          THEN 'price_scale'
                        WHEN p_price IS NULL THEN 'bad_price'
                        WHEN p_quantity IS NULL THEN 'bad_quantity'
                        WHEN p_traded_at IS NULL THEN 'bad_time'
                        WHEN p_reference_date IS NULL THEN 'bad_reference_date'
                        WHEN p_session_type IS NULL THEN 'bad_session_type'
                   END || ': ' || {py_repr('raw_line')}
         END AS error
  FROM typed
)"""

ORACLE["parse_trade_lines"] = with_ctes(TRADE_LINES, PARSED_LINES, body="""
SELECT filename, ticker, trade_id, "action", price, quantity, traded_at, trade_date,
       reference_date, session_type
FROM parsed WHERE error IS NULL""")

ORACLE["dead_letters"] = with_ctes(TRADE_LINES, PARSED_LINES, body="""
SELECT 1 AS schema_version, file_ticker AS ticker, session_date, filename, source, error, raw_line
FROM parsed WHERE error IS NOT NULL""")

ORACLE["trade_events_json"] = with_ctes(TRADE_LINES, PARSED_LINES, body=f"""
SELECT ticker AS "key",
       CAST(json_object('schema_version', 1, 'ticker', ticker, 'trade_id', trade_id,
                   'action', "action", 'price', CAST(price AS VARCHAR), 'quantity', quantity,
                   'traded_at', {iso_instant('traded_at')},
                   'trade_date', CAST(trade_date AS VARCHAR),
                   'reference_date', CAST(reference_date AS VARCHAR),
                   'session_type', session_type, 'source', 'eod_file') AS VARCHAR) AS "value"
FROM parsed WHERE error IS NULL""")

ORACLE["decode_events"] = """
WITH v AS (
  SELECT event_id,
         CASE event_id % 50 WHEN 0 THEN 'not json' WHEN 1 THEN '[1,2]' WHEN 2 THEN '{"k":"abc"}'
              WHEN 3 THEN '{"foo":1}' ELSE props END AS value
  FROM events
)
SELECT event_id,
       CASE WHEN json_valid(value) AND json_type(CAST(value AS JSON)) = 'OBJECT'
            THEN TRY_CAST(json_extract_string(value, '$.k') AS BIGINT) END AS k
FROM v"""

CURSOR0 = """
cursor0 AS (
  SELECT ticker, trade_date, greatest(max(trade_id), 0) AS max_trade_id
  FROM trades_raw WHERE trade_id % 10 <= 3 AND "action" <> 2
  GROUP BY ticker, trade_date
),
good AS (SELECT * FROM parsed WHERE error IS NULL),
published AS (
  SELECT g.* FROM good g LEFT JOIN cursor0 c USING (ticker, trade_date)
  WHERE g."action" = 2 OR g.trade_id > coalesce(c.max_trade_id, 0)
)"""

ORACLE["cursor_filter"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, CURSOR0, body="""
SELECT filename, ticker, trade_id, "action", price, quantity, traded_at, trade_date,
       reference_date, session_type FROM published""")

ORACLE["cursor_updates"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, CURSOR0, body="""
SELECT ticker || ':' || CAST(trade_date AS VARCHAR) AS "key", ticker, trade_date,
       CAST(greatest(max(trade_id), 0) AS BIGINT) AS max_trade_id
FROM published WHERE "action" <> 2 GROUP BY ticker, trade_date""")

ORACLE["cursor_fold"] = """
WITH log AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS "key",
         CASE WHEN event_type = 'error' THEN NULL
              ELSE '{"max_trade_id": ' || json_extract_string(props, '$.k') || '}' END AS "value",
         CAST(user_id % 12 AS INTEGER) AS "partition", event_id AS "offset"
  FROM events
),
newest AS (
  SELECT "key", arg_max({'v': "value"}, {'p': "partition", 'o': "offset"}).v AS "value"
  FROM log GROUP BY "key"
)
SELECT "key", CAST(json_extract("value", '$.max_trade_id') AS BIGINT) AS max_trade_id
FROM newest WHERE "value" IS NOT NULL"""

ORACLE["replay_counts"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, CURSOR0, body="""
, upd AS (
  SELECT ticker, trade_date, greatest(max(trade_id), 0) AS max_trade_id
  FROM published WHERE "action" <> 2 GROUP BY ticker, trade_date
),
cursor1 AS (
  SELECT ticker, trade_date, greatest(c.max_trade_id, u.max_trade_id) AS max_trade_id
  FROM cursor0 c FULL JOIN upd u USING (ticker, trade_date)
),
second AS (
  SELECT g.* FROM good g LEFT JOIN cursor1 c USING (ticker, trade_date)
  WHERE g."action" = 2 OR g.trade_id > coalesce(c.max_trade_id, 0)
),
a AS (SELECT ticker, trade_date, count(*) FILTER (WHERE "action" <> 2) AS first_new,
             count(*) FILTER (WHERE "action" = 2) AS first_cancels
      FROM published GROUP BY ALL),
b AS (SELECT ticker, trade_date, count(*) FILTER (WHERE "action" <> 2) AS replay_new,
             count(*) FILTER (WHERE "action" = 2) AS replay_cancels
      FROM second GROUP BY ALL)
SELECT ticker, trade_date, coalesce(first_new, 0) AS first_new,
       coalesce(first_cancels, 0) AS first_cancels, coalesce(replay_new, 0) AS replay_new,
       coalesce(replay_cancels, 0) AS replay_cancels
FROM a FULL JOIN b USING (ticker, trade_date)""")

TODAY = f"CAST(timezone('America/Sao_Paulo', timezone('UTC', TIMESTAMP '{AS_OF}')) AS DATE)"

ORDERS_DIV = f"""
ord AS (
  SELECT *, {TK.format(k='o_custkey')} AS ticker, CAST(o_orderdate AS DATE) AS d,
         'BR' || substr({TK.format(k='o_custkey')}, 1, 3)
           || CASE WHEN o_orderkey % 2 = 0 THEN 'ACNOR' ELSE 'ACNPR' END
           || CAST(o_orderkey % 10 AS VARCHAR) AS isin,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'JRS CAP PROPRIO' WHEN '2-HIGH' THEN 'RENDIMENTO'
              ELSE 'DIVIDENDO' END AS label,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(20,11)) AS rate,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.1 AS DECIMAL(20,11)) AS factor,
         CASE o_orderkey % 3 WHEN 0 THEN 'DESDOBRAMENTO' WHEN 1 THEN 'GRUPAMENTO'
              ELSE 'BONIFICACAO' END AS stock_label
  FROM orders
),
cash_dividends AS (
  SELECT ticker, isin, label, rate, d AS approved_on, d + 10 AS last_date_prior,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE d + 60 END AS payment_date,
         'Anual/' || CAST(year(d) AS VARCHAR) AS related_to,
         TIMESTAMP '{SYNCED_AT}' AS synced_at
  FROM ord
),
stock_dividends AS (
  SELECT ticker, isin, stock_label AS label, factor, d AS approved_on, d + 10 AS last_date_prior,
         TIMESTAMP '{SYNCED_AT}' AS synced_at,
         o_orderpriority = '5-LOW' AS listed  -- in the supplement documents
  FROM ord
)"""

# Share class kept: ticker digit 3 with ACNOR, digit 4 with ACNPR.
CLASS_MATCH = """(isin LIKE 'BR' || substr(ticker, 1, 3)
       || CASE substr(ticker, 4, 1) WHEN '3' THEN 'ACNOR' WHEN '4' THEN 'ACNPR' END || '%')"""

WATCHED = "ticker IN (SELECT DISTINCT 'TK' || lpad(CAST(s_suppkey % 20 AS VARCHAR), 2, '0') FROM supplier)"

ORACLE["parse_cash_dividends"] = with_ctes(ORDERS_DIV, body=f"""
SELECT DISTINCT ticker, isin, label, rate, approved_on, last_date_prior, payment_date, related_to
FROM cash_dividends WHERE coalesce({CLASS_MATCH}, false) AND {WATCHED}""")

ORACLE["parse_stock_dividends"] = with_ctes(ORDERS_DIV, body=f"""
SELECT DISTINCT ticker, isin, label, factor, approved_on, last_date_prior
FROM stock_dividends WHERE listed AND coalesce({CLASS_MATCH}, false) AND {WATCHED}""")

ORACLE["supplement_errors"] = """
SELECT o_orderkey AS doc_id, 1 AS row_no,
       'bad cash dividend row: missing isinCode,label,rate,approvedOn,lastDatePrior,paymentDate'
         AS error
FROM orders WHERE o_orderkey % 13 = 0"""

ORACLE["dividend_status"] = with_ctes(ORDERS_DIV, body=f"""
SELECT ticker, isin, label, approved_on, last_date_prior, payment_date,
       (payment_date IS NULL OR payment_date > {TODAY}) AS pending,
       CASE WHEN {TODAY} <= last_date_prior THEN 'with_rights' ELSE 'pending_payment' END
         AS status_sql,
       CASE WHEN {TODAY} <= last_date_prior THEN 'with_rights'
            WHEN payment_date IS NULL OR payment_date > {TODAY} THEN 'pending_payment'
            ELSE 'paid' END AS status
FROM cash_dividends""")

PENDING_BODY = f"""
SELECT d.ticker, d.label AS "type",
       CASE WHEN {TODAY} <= d.last_date_prior THEN 'with_rights' ELSE 'pending_payment' END
         AS status,
       CAST(d.rate AS VARCHAR) AS gross_per_share,
       CASE WHEN d.label = 'JRS CAP PROPRIO' THEN CAST(d.rate * 0.85 AS VARCHAR)
            ELSE CAST(d.rate AS VARCHAR) END AS net_per_share,
       CASE WHEN d.label = 'JRS CAP PROPRIO'
            THEN 'JCP: 15% IRRF withheld at source; published rate is gross'
            ELSE 'dividends currently exempt from IRRF for individuals' END AS tax_note,
       CAST(d.approved_on AS VARCHAR) AS approved_on,
       CAST(d.last_date_prior AS VARCHAR) AS buy_by,
       CAST(d.payment_date AS VARCHAR) AS payment_date,
       d.payment_date IS NULL AS payment_tbd,
       round(CAST(d.rate AS DOUBLE) / CAST(p.price AS DOUBLE), 6) AS yield_on_last_price,
       CAST(p.price AS VARCHAR) AS last_price,
       {iso_instant('p.traded_at')} AS price_as_of
FROM cash_dividends d JOIN last_price p USING (ticker)
WHERE (d.payment_date IS NULL OR d.payment_date > {TODAY}) {{extra}}
ORDER BY d.ticker, d.payment_date NULLS LAST"""

ORACLE["pending_dividends"] = with_ctes(
    TRADES_RAW, TRADES_CLEAN, LAST_PRICE, ORDERS_DIV, body=PENDING_BODY.format(extra=""))
ORACLE["pending_dividends_one"] = with_ctes(
    TRADES_RAW, TRADES_CLEAN, LAST_PRICE, ORDERS_DIV,
    body=PENDING_BODY.format(extra="AND d.ticker = upper(trim(' tk04 '))"))


def today_sql(as_of: str) -> str:
    return f"CAST(timezone('America/Sao_Paulo', timezone('UTC', TIMESTAMP '{as_of}')) AS DATE)"


def pending_rows_sql(as_of: str) -> str:
    t = today_sql(as_of)
    return f"""
SELECT d.ticker, d.label AS "type",
       CASE WHEN {t} <= d.last_date_prior THEN 'with_rights' ELSE 'pending_payment' END AS status,
       CAST(d.rate AS VARCHAR) AS gross_per_share,
       CASE WHEN d.label = 'JRS CAP PROPRIO' THEN CAST(d.rate * 0.85 AS VARCHAR)
            ELSE CAST(d.rate AS VARCHAR) END AS net_per_share,
       CASE WHEN d.label = 'JRS CAP PROPRIO'
            THEN 'JCP: 15% IRRF withheld at source; published rate is gross'
            ELSE 'dividends currently exempt from IRRF for individuals' END AS tax_note,
       CAST(d.approved_on AS VARCHAR) AS approved_on,
       CAST(d.last_date_prior AS VARCHAR) AS buy_by,
       CAST(d.payment_date AS VARCHAR) AS payment_date,
       d.payment_date IS NULL AS payment_tbd,
       round(CAST(d.rate AS DOUBLE) / CAST(p.price AS DOUBLE), 6) AS yield_on_last_price
FROM cash_dividends d JOIN last_price p USING (ticker)
WHERE d.payment_date IS NULL OR d.payment_date > {t}"""


LATEST_SESSION = """
latest_session AS (
  SELECT ticker, trade_date, "open", high, low, "close", quantity, financial_volume, trades
  FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn
        FROM session_summary) WHERE rn = 1
)"""


def documents_sql(as_of: str) -> str:
    return f"""
SELECT p.ticker, CAST(p.price AS VARCHAR) AS last_price, {iso_instant('p.traded_at')} AS price_as_of,
       CAST(s.trade_date AS VARCHAR) AS session_date, CAST(s."open" AS VARCHAR) AS session_open,
       CAST(s.high AS VARCHAR) AS session_high, CAST(s.low AS VARCHAR) AS session_low,
       CAST(s."close" AS VARCHAR) AS session_close, s.quantity AS session_quantity,
       CAST(s.financial_volume AS VARCHAR) AS session_financial_volume,
       s.trades AS session_trades,
       i."type", i.status, i.gross_per_share, i.net_per_share, i.tax_note, i.approved_on,
       i.buy_by, i.payment_date, i.payment_tbd, i.yield_on_last_price
FROM last_price p LEFT JOIN latest_session s USING (ticker)
     LEFT JOIN ({pending_rows_sql(as_of)}) i USING (ticker)"""


SERVING = (TRADES_RAW, TRADES_CLEAN, LAST_PRICE, SESSION_SUMMARY, LATEST_SESSION, ORDERS_DIV)

ORACLE["latest_session"] = with_ctes(TRADES_RAW, TRADES_CLEAN, SESSION_SUMMARY, LATEST_SESSION,
                                     body="SELECT * FROM latest_session")
ORACLE["ticker_documents"] = with_ctes(*SERVING, body=documents_sql(AS_OF))


def _etags(as_of: str) -> str:
    hdr = ["last_price", "price_as_of", "session_date", "session_open", "session_high",
           "session_low", "session_close", "CAST(session_quantity AS VARCHAR)",
           "session_financial_volume", "CAST(session_trades AS VARCHAR)"]
    items = ['"type"', "status", "gross_per_share", "net_per_share", "tax_note", "approved_on",
             "buy_by", "payment_date", "CAST(payment_tbd AS VARCHAR)"]
    cat = lambda cols: "concat_ws('|', " + ", ".join(f"coalesce({c}, '')" for c in cols) + ")"
    item = (f"concat_ws('|', {cat(items)}, "
            f"CAST(CAST(round(yield_on_last_price * 1000000.0) AS BIGINT) AS VARCHAR))")
    return f"""
SELECT ticker, pending_count,
       '"' || substr(sha256(concat_ws('|', ticker, header, CAST(pending_count AS VARCHAR),
                                      CAST(digest AS VARCHAR))), 1, 16) || '"' AS etag
FROM (
  SELECT ticker, first({cat(hdr)}) AS header,
         count(*) FILTER (WHERE "type" IS NOT NULL) AS pending_count,
         CAST(coalesce(sum(CAST(('0x' || substr(sha256({item}), 1, 15)) AS BIGINT))
                FILTER (WHERE "type" IS NOT NULL), 0) AS DECIMAL(38,0)) AS digest
  FROM ({documents_sql(as_of)}) GROUP BY ticker
)"""


ORACLE["changed_documents"] = with_ctes(*SERVING, body=f"""
SELECT ticker, b.etag AS etag_before, n.etag AS etag_now,
       NOT (b.etag IS NOT DISTINCT FROM n.etag) AS changed
FROM ({_etags(PREV_AS_OF)}) b FULL JOIN ({_etags(AS_OF)}) n USING (ticker)""")

ORACLE["unknown_tickers"] = with_ctes(TRADES_RAW, TRADES_CLEAN, LAST_PRICE, body="""
, req AS (
  SELECT DISTINCT upper(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' || lower(raw) || ' ' ELSE raw END))
           AS ticker
  FROM (SELECT c_custkey, 'TK' || lpad(CAST(c_custkey % 25 AS VARCHAR), 2, '0') AS raw FROM customer)
)
SELECT ticker AS requested, 'ticker ' || ticker || ' is not tracked' AS error,
       (SELECT CAST(to_json(list(ticker ORDER BY ticker)) AS VARCHAR) FROM last_price)
         AS available_tickers
FROM req WHERE ticker NOT IN (SELECT ticker FROM last_price)""")


def _age(now: str, then: str) -> str:
    return (f"CASE WHEN {then} IS NOT NULL THEN CAST(trunc((epoch_us({now}) - epoch_us({then}))"
            f" / 1000000.0) AS BIGINT) END")


ORACLE["health_report"] = with_ctes(*SERVING, body=f"""
, h AS (
  SELECT (SELECT max(traded_at) FROM last_price) AS lt,
         (SELECT max(synced_at) FROM cash_dividends) AS sy,
         (SELECT max(trade_date) FROM session_summary) AS ls,
         (SELECT count(*) FROM session_summary) AS sc,
         TIMESTAMP '{AS_OF}' AS now
),
w AS (
  SELECT *, timezone('America/Sao_Paulo', timezone('UTC', now)) AS lnow FROM h
),
f AS (
  SELECT *,
    (isodow(lnow) <= 5 AND CAST(lnow AS TIME) >= TIME '09:55:00'
       AND CAST(lnow AS TIME) <= TIME '18:35:00') AS win,
    coalesce(lt IS NOT NULL AND (NOT (isodow(lnow) <= 5 AND CAST(lnow AS TIME) >= TIME '09:55:00'
       AND CAST(lnow AS TIME) <= TIME '18:35:00')
       OR epoch_us(now) - epoch_us(lt) <= 1800000000), false) AS tf,
    coalesce(sy IS NOT NULL AND epoch_us(now) - epoch_us(sy) <= 25200000000, false) AS af
  FROM w
)
SELECT CASE WHEN tf AND af THEN 'ok' ELSE 'degraded' END AS status,
       {iso_instant('now')} AS checked_at, win AS market_window_open,
       {iso_instant('lt')} AS trades_latest_traded_at, {_age('now', 'lt')} AS trades_age_seconds,
       tf AS trades_fresh,
       'freshness here proves the whole chain: landed files -> event log -> gold tables' AS trades_note,
       {iso_instant('sy')} AS actions_last_synced_at, {_age('now', 'sy')} AS actions_age_seconds,
       af AS actions_fresh, CAST(ls AS VARCHAR) AS sessions_latest, sc AS sessions_count
FROM f""")

PENDING_NUM = f"""
pending_num AS (
  SELECT d.ticker, d.label, d.rate,
         CASE WHEN d.label = 'JRS CAP PROPRIO' THEN d.rate * 0.85 ELSE d.rate END AS net,
         d.payment_date, p.price, p.traded_at
  FROM cash_dividends d JOIN last_price p USING (ticker)
  WHERE d.payment_date IS NULL OR d.payment_date > {today_sql(AS_OF)}
),
radar_y AS (
  SELECT *, CAST(gross AS DOUBLE) / CAST(price AS DOUBLE) AS total_yield FROM (
    SELECT ticker, count(*) AS events, CAST(sum(rate) AS DECIMAL(38,11)) AS gross,
           CAST(sum(net) AS DECIMAL(38,13)) AS net, first(price) AS price,
           min(payment_date) AS next_payment,
           count(*) FILTER (WHERE label = 'JRS CAP PROPRIO') AS jcp_events
    FROM pending_num GROUP BY ticker)
)"""

ORACLE["dividend_radar"] = with_ctes(*SERVING, PENDING_NUM, body="""
SELECT *, greatest(2.0, 100.0 * total_yield / (SELECT greatest(max(total_yield), 1e-9) FROM radar_y))
         AS bar_width
FROM radar_y ORDER BY total_yield DESC, ticker""")

ORACLE["radar_headline"] = with_ctes(*SERVING, PENDING_NUM, body=f"""
, best AS (SELECT ticker, total_yield, events FROM radar_y ORDER BY total_yield DESC, ticker LIMIT 1)
SELECT (SELECT CAST(sum(events) AS BIGINT) FROM radar_y) AS pending_events,
       (SELECT count(*) FROM radar_y) AS tickers,
       best.ticker AS best_ticker, best.total_yield AS best_yield, best.events AS best_events,
       (SELECT count(*) FROM pending_num WHERE payment_date IS NULL) AS undated_events,
       {_age(f"TIMESTAMP '{AS_OF}'", '(SELECT max(traded_at) FROM last_price)')}
         AS newest_trade_age_seconds
FROM best""")

ORACLE["radar_events"] = with_ctes(*SERVING, body=f"""
SELECT ticker,
       CASE "type" WHEN 'JRS CAP PROPRIO' THEN 'JCP' WHEN 'DIVIDENDO' THEN 'Dividendo'
                   WHEN 'RENDIMENTO' THEN 'Rendimento' ELSE "type" END AS type_short,
       status, payment_date, payment_tbd, yield_on_last_price
FROM ({pending_rows_sql(AS_OF)}) ORDER BY ticker, payment_date NULLS LAST""")

ORACLE["day_change"] = with_ctes(TRADES_RAW, TRADES_CLEAN, SESSION_SUMMARY, LATEST_SESSION, body="""
SELECT ticker, trade_date,
       (CAST("close" AS DOUBLE) - CAST("open" AS DOUBLE)) / CAST("open" AS DOUBLE) AS day_change,
       CASE WHEN (CAST("close" AS DOUBLE) - CAST("open" AS DOUBLE)) / CAST("open" AS DOUBLE) >= 0
            THEN 'up' ELSE 'down' END AS direction
FROM latest_session WHERE "open" IS NOT NULL AND "close" IS NOT NULL""")

ORACLE["range_position"] = with_ctes(*SERVING, body="""
, s AS (
  SELECT ticker, trade_date, CAST("open" AS DOUBLE) AS o, CAST(low AS DOUBLE) AS lo,
         CAST(high AS DOUBLE) AS hi,
         CASE WHEN CAST(high AS DOUBLE) - CAST(low AS DOUBLE) = 0 THEN 1.0
              ELSE CAST(high AS DOUBLE) - CAST(low AS DOUBLE) END AS span
  FROM latest_session WHERE low IS NOT NULL AND high IS NOT NULL
)
SELECT s.ticker, s.trade_date, 100.0 * (o - lo) / span AS open_position,
       100.0 * (CAST(p.price AS DOUBLE) - lo) / span AS last_position
FROM s JOIN last_price p USING (ticker)""")

ORACLE["trading_calendar"] = with_ctes(TRADES_RAW, body="""
, runs AS (SELECT DISTINCT reference_date AS run_date FROM trades_raw),
days AS (
  SELECT run_date, CAST(unnest(generate_series(CAST(run_date - 28 AS TIMESTAMP),
                                               CAST(run_date - 1 AS TIMESTAMP),
                                               INTERVAL 1 DAY)) AS DATE) AS session_date
  FROM runs
)
SELECT run_date, session_date FROM days WHERE isodow(session_date) <= 5""")

PUBLISH_AUDIT = """
, totals AS (SELECT file_ticker, session_date, filename, count(*) AS total FROM good GROUP BY ALL),
news AS (SELECT file_ticker, session_date, filename, count(*) AS published FROM published GROUP BY ALL),
lasts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_ticker, session_date, filename
                                              ORDER BY line_no DESC, raw_line DESC) AS rn
                 FROM published) WHERE rn = 1
),
audit AS (
  SELECT t.file_ticker AS ticker, t.session_date, t.filename, t.total,
         coalesce(n.published, 0) AS published, l.price AS last_price, l.traded_at AS last_traded_at
  FROM totals t LEFT JOIN news n USING (file_ticker, session_date, filename)
       LEFT JOIN lasts l USING (file_ticker, session_date, filename)
)"""

ORACLE["publish_audit"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, CURSOR0,
                                    body=PUBLISH_AUDIT + "\nSELECT * FROM audit")
ORACLE["backfill_progress"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, CURSOR0, body=PUBLISH_AUDIT + """
SELECT session_date, count(*) AS files, CAST(sum(total) AS BIGINT) AS parsed,
       CAST(sum(published) AS BIGINT) AS published,
       (SELECT count(DISTINCT session_date) FROM trade_lines) AS sessions_total
FROM audit GROUP BY session_date""")

ORACLE["action_audit"] = with_ctes(ORDERS_DIV, body=f"""
, c AS (
  SELECT ticker, count(*) AS cash,
         count(*) FILTER (WHERE CASE WHEN {today_sql(AS_OF)} <= last_date_prior THEN 'with_rights'
                                     WHEN payment_date IS NULL OR payment_date > {today_sql(AS_OF)}
                                       THEN 'pending_payment' ELSE 'paid' END <> 'paid') AS pending
  FROM cash_dividends GROUP BY ticker
),
s AS (SELECT ticker, count(*) AS stock FROM stock_dividends GROUP BY ticker)
SELECT ticker, coalesce(cash, 0) AS cash, coalesce(stock, 0) AS stock,
       coalesce(pending, 0) AS pending
FROM c FULL JOIN s USING (ticker)""")


def _constraints() -> str:
    from ticklake.schemas import KEYS, NOT_NULL
    parts = []
    for table in ("last_price", "session_summary", "cash_dividends", "stock_dividends",
                  "tracked_tickers"):
        for col in NOT_NULL.get(table, []):
            parts.append(f"SELECT '{table}' AS table_name, 'not null {col}' AS rule, "
                         f"count(*) FILTER (WHERE {col} IS NULL) AS violations FROM {table}")
        if table in KEYS:
            k = ", ".join(KEYS[table])
            parts.append(f"SELECT '{table}' AS table_name, 'duplicate key ({','.join(KEYS[table])})' "
                         f"AS rule, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations "
                         f"FROM (SELECT {k}, count(*) AS n FROM {table} GROUP BY {k} HAVING count(*) > 1)")
    return "\nUNION ALL\n".join(parts)


TRACKED = """
tracked_tickers AS (
  SELECT DISTINCT 'TK' || lpad(CAST(s_suppkey % 20 AS VARCHAR), 2, '0') AS ticker FROM supplier
)"""

ORACLE["constraint_violations"] = with_ctes(*SERVING, TRACKED, body=_constraints())

ORACLE["download_classes"] = with_ctes(TRADE_LINES, body="""
, files AS (
  SELECT ticker, session_date, CAST(sum(length(raw_line) + 1) AS BIGINT) AS body_bytes
  FROM trade_lines GROUP BY ticker, session_date
),
m AS (
  SELECT ticker, session_date,
         CASE WHEN month(session_date) % 4 = 0 AND day(session_date) = 2 THEN 404
              WHEN ticker = 'TK07' AND month(session_date) % 2 = 1 THEN 403
              WHEN ticker = 'TK13' AND month(session_date) = 12 THEN 503
              ELSE 200 END AS http_status,
         NOT (ticker = 'TK05' AND day(session_date) = 1 AND month(session_date) % 3 = 0)
           AS has_cd,
         (ticker = 'TK11' AND month(session_date) <= 2) AS empty,
         body_bytes
  FROM files
),
c AS (
  SELECT *, CASE WHEN http_status = 200 AND NOT empty THEN body_bytes ELSE 0 END AS content_length
  FROM m
)
SELECT ticker, session_date, http_status,
       CASE WHEN http_status = 404 THEN 'unavailable' WHEN http_status <> 200 THEN 'fetch_error'
            WHEN content_length = 0 OR NOT has_cd THEN 'unavailable' ELSE 'ok' END AS class,
       CASE WHEN http_status = 404 THEN 'not published (404)'
            WHEN http_status <> 200 THEN 'unexpected HTTP ' || CAST(http_status AS VARCHAR)
            WHEN content_length = 0 OR NOT has_cd THEN 'empty body / missing content-disposition'
       END AS reason
FROM c""")

# The delivered events and late cancellations of line 1 of every third order.
TRADES_LATE = TRADES_RAW.replace("trades_raw AS (", "delivered AS (", 1) + """,
trades_raw AS (
  SELECT * FROM delivered
  UNION ALL
  SELECT * REPLACE (2 AS "action") FROM delivered WHERE trade_id % 30 = 1
)"""

ORACLE["stream_session_summary"] = with_ctes(TRADES_LATE, TRADES_CLEAN, SESSION_SUMMARY,
                                             body="SELECT * FROM session_summary")
ORACLE["rebuild_gold"] = ORACLE["stream_session_summary"]
ORACLE["stream_last_price"] = with_ctes(TRADES_LATE, TRADES_CLEAN, LAST_PRICE, body="SELECT * FROM last_price")

ORACLE["backfill_sweep"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, CURSOR0, body="""
, cal AS (
  SELECT DISTINCT CAST(day AS DATE) AS session_date
  FROM (SELECT DISTINCT reference_date AS r FROM trades_raw),
       LATERAL (SELECT unnest(generate_series(CAST(r - 28 AS TIMESTAMP), CAST(r - 1 AS TIMESTAMP),
                                              INTERVAL 1 DAY)) AS day)
  WHERE isodow(day) <= 5
),
swept AS (
  SELECT g.*, coalesce(c.max_trade_id, 0) AS before
  FROM good g SEMI JOIN cal USING (session_date) LEFT JOIN cursor0 c USING (ticker, trade_date)
),
after AS (
  SELECT ticker, trade_date, greatest(max(before), max(trade_id) FILTER (WHERE "action" <> 2)) AS moved
  FROM swept GROUP BY ALL
),
counted AS (
  SELECT file_ticker AS ticker, session_date, filename, count(*) AS parsed,
         count(*) FILTER (WHERE "action" = 2 OR trade_id > before) AS published,
         count(*) FILTER (WHERE "action" <> 2 AND trade_id > moved) AS published_again
  FROM swept JOIN after USING (ticker, trade_date) GROUP BY ALL
)
SELECT f.ticker, f.session_date, f.filename, coalesce(parsed, 0) AS parsed,
       coalesce(published, 0) AS published, coalesce(published_again, 0) AS published_again
FROM (SELECT DISTINCT ticker, session_date, filename FROM trade_lines SEMI JOIN cal USING (session_date)) f
     LEFT JOIN counted USING (ticker, session_date, filename)""")

FIRST_SYNC = "2001-06-01 08:00:00"

ORACLE["corporate_actions_sync"] = with_ctes(ORDERS_DIV, body=f"""
, fetched AS (
  SELECT *, (o_orderkey // 2) % 2 AS round FROM ord
  WHERE {WATCHED} AND NOT ((o_orderkey // 2) % 2 = 1 AND ticker IN ('TK04', 'TK14'))
),
mirrored AS (
  SELECT ticker, max(round) AS round, arg_max(o_orderkey, {{'r': round, 'k': o_orderkey}}) AS o_orderkey
  FROM fetched GROUP BY ticker
),
held AS (
  SELECT f.*, CASE f.round WHEN 0 THEN TIMESTAMP '{FIRST_SYNC}' ELSE TIMESTAMP '{SYNCED_AT}' END AS synced_at
  FROM fetched f JOIN mirrored USING (ticker, o_orderkey)
  WHERE {CLASS_MATCH}
),
live AS (
  SELECT DISTINCT 'cash' AS table_name, ticker, isin, label, rate AS amount, d AS approved_on, synced_at FROM held
  UNION ALL
  SELECT DISTINCT 'stock', ticker, isin, stock_label, factor, d, synced_at FROM held
  WHERE o_orderpriority = '5-LOW'
)
SELECT *, false AS is_marker FROM live
UNION ALL
SELECT t.table_name, m.ticker, NULL, NULL, NULL, NULL, NULL, true
FROM mirrored m, (VALUES ('cash'), ('stock')) t(table_name)
WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.ticker = m.ticker AND l.table_name = t.table_name)""")

ORACLE["stream_cursor"] = with_ctes(TRADE_LINES, PARSED_LINES, body="""
, good AS (SELECT * FROM parsed WHERE error IS NULL),
d0 AS (SELECT * FROM good WHERE trade_id % 10 <= 3),
c0 AS (SELECT ticker, trade_date, greatest(max(trade_id), 0) AS m FROM d0
       WHERE "action" <> 2 GROUP BY ticker, trade_date),
pub AS (
  SELECT 0 AS "drop", * FROM d0 WHERE "action" = 2 OR trade_id > 0
  UNION ALL
  SELECT 1 AS "drop", g.* FROM good g LEFT JOIN c0 USING (ticker, trade_date)
  WHERE g."action" = 2 OR g.trade_id > coalesce(c0.m, 0)
)
SELECT "drop", ticker, trade_id, "action", price, quantity, traded_at, trade_date,
       reference_date, session_type FROM pub""")

ORACLE["ingest_events"] = with_ctes(TRADE_LINES, PARSED_LINES, body="""
SELECT 1 AS schema_version, ticker, trade_id, "action", CAST(price AS VARCHAR) AS price, quantity,
       traded_at, trade_date, reference_date, session_type, 'eod_file' AS source
FROM parsed WHERE error IS NULL""")

ORACLE["stream_event_counts"] = with_ctes(TRADES_LATE, body="""
SELECT CASE WHEN trade_id % 97 <> 5 THEN ticker END AS ticker, trade_date, count(*) AS events
FROM trades_raw GROUP BY ALL""")

ORACLE["recover_event_counts"] = with_ctes(TRADES_LATE, body="""
SELECT ticker, trade_date, count(*) AS events FROM trades_raw GROUP BY ALL""")

ORACLE["cursor_compacted"] = ORACLE["cursor_fold"]

# Some trades without a time; the newest day is lost.
TRADES_LEFT = TRADES_RAW.replace("trades_raw AS (", "landed AS (", 1) + """,
delivered AS (
  SELECT * REPLACE (CASE WHEN trade_id % 211 <> 7 THEN traded_at END AS traded_at) FROM landed
  WHERE trade_date < (SELECT max(trade_date) FROM landed)
),
trades_raw AS (
  SELECT * FROM delivered
  UNION ALL
  SELECT * REPLACE (2 AS "action") FROM delivered WHERE trade_id % 30 = 1
)"""

ORACLE["rebuild_vanished_day"] = with_ctes(TRADES_LEFT, TRADES_CLEAN, SESSION_SUMMARY, body="""
, newest AS (
  SELECT ticker, arg_max({'p': price, 't': traded_at}, {'t': traded_at, 'id': trade_id, 'd': trade_date}) AS x
  FROM live WHERE price IS NOT NULL AND traded_at IS NOT NULL GROUP BY ticker
),
latest AS (
  SELECT ticker, trade_date, arg_max({'p': price, 't': traded_at}, nth) AS x FROM live GROUP BY ALL
)
SELECT 'session_summary' AS table_name, ticker, trade_date, "close" AS price, NULL::TIMESTAMP AS traded_at
FROM session_summary
UNION ALL SELECT 'last_price', ticker, NULL, x.p, x.t FROM newest
UNION ALL SELECT 'violations', ticker, trade_date, x.p, x.t FROM latest WHERE x.p IS NULL OR x.t IS NULL""")

ORACLE["text_line_scan"] = with_ctes(TRADE_LINES, body="""
SELECT ticker AS file_ticker, session_date,
       row_number() OVER (PARTITION BY ticker, session_date ORDER BY line_no, raw_line) AS line_no, raw_line
FROM trade_lines""")

ORACLE["late_ids"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, CURSOR0, body="""
, sent AS (SELECT DISTINCT ticker, trade_date, trade_id FROM trades_raw WHERE trade_id % 10 <= 3 AND "action" <> 2),
late AS (
  SELECT DISTINCT g.ticker, g.trade_date, g.trade_id
  FROM good g JOIN cursor0 c USING (ticker, trade_date)
  WHERE g."action" <> 2 AND g.trade_id <= c.max_trade_id
    AND NOT EXISTS (SELECT 1 FROM sent s WHERE s.ticker = g.ticker AND s.trade_date = g.trade_date
                    AND s.trade_id = g.trade_id)
),
grouped AS (
  SELECT *, trade_id - row_number() OVER (PARTITION BY ticker, trade_date ORDER BY trade_id) AS island FROM late
)
SELECT ticker, trade_date, min(trade_id) AS first_id, max(trade_id) AS last_id, count(*) AS ids
FROM grouped GROUP BY ticker, trade_date, island""")

ORACLE["document_changes"] = with_ctes(*SERVING, body=f"""
, snap AS (
  SELECT 1 AS version, ticker, etag FROM ({_etags(PREV_AS_OF)}) WHERE ticker <> 'TK03'
  UNION ALL SELECT 2, ticker, etag FROM ({_etags(AS_OF)})
  UNION ALL SELECT 3, ticker, etag FROM ({_etags(AS_OF)}) WHERE ticker <> 'TK11'
),
pairs AS (
  SELECT n.v AS version, b.ticker AS before_ticker, b.etag AS digest_before, a.ticker AS now_ticker, a.etag AS digest_now,
         coalesce(b.ticker, a.ticker) AS ticker
  FROM (VALUES (1), (2), (3)) n(v), (SELECT DISTINCT ticker FROM snap) t
  LEFT JOIN snap b ON b.ticker = t.ticker AND b.version = n.v - 1
  LEFT JOIN snap a ON a.ticker = t.ticker AND a.version = n.v
)
SELECT version, ticker, CASE WHEN before_ticker IS NULL THEN 'added' WHEN now_ticker IS NULL THEN 'gone' ELSE 'changed' END AS change,
       digest_before, digest_now
FROM pairs WHERE ticker IS NOT NULL AND digest_before IS DISTINCT FROM digest_now""")

ORACLE["contract_violations"] = with_ctes(ORDERS_DIV, body="""
, faulty AS (
  SELECT ticker, approved_on, last_date_prior,
         CASE WHEN NOT suffix(CAST(approved_on AS VARCHAR), '7') THEN label END AS label,
         CASE WHEN month(approved_on) <> 2 THEN related_to END AS related_to,
         CASE WHEN day(approved_on) = 13 THEN -rate ELSE rate END AS rate
  FROM cash_dividends
),
checked AS (
  SELECT *, ticker IS NULL AS a, label IS NULL AS b, related_to IS NULL AS c, NOT coalesce(rate > 0, false) AS d,
         NOT coalesce(last_date_prior > approved_on, false) AS e FROM faulty
)
SELECT 'rows' AS rule, count(*) AS violations FROM checked
UNION ALL SELECT 'not null ticker', count(*) FILTER (WHERE a) FROM checked
UNION ALL SELECT 'not null label', count(*) FILTER (WHERE b) FROM checked
UNION ALL SELECT 'not null related_to', count(*) FILTER (WHERE c) FROM checked
UNION ALL SELECT 'rate above 0', count(*) FILTER (WHERE d) FROM checked
UNION ALL SELECT 'last day after approval', count(*) FILTER (WHERE e) FROM checked
UNION ALL SELECT 'quarantined', count(*) FILTER (WHERE a OR b OR c OR d OR e) FROM checked
UNION ALL SELECT 'kept', count(*) FILTER (WHERE NOT (a OR b OR c OR d OR e)) FROM checked
UNION ALL SELECT 'duplicate key (ticker,approved_on)', count(*) - count(DISTINCT (ticker, approved_on)) FROM faulty""")


# A poll of line numbers 1-3 (batch 0), then two sweeps over the calendar's sessions.
SWEPT = f"""
, cal AS (
  SELECT DISTINCT CAST(day AS DATE) AS session_date
  FROM (SELECT DISTINCT reference_date AS r FROM trades_raw),
       LATERAL (SELECT unnest(generate_series(CAST(r - 28 AS TIMESTAMP), CAST(r - 1 AS TIMESTAMP),
                                              INTERVAL 1 DAY)) AS day)
  WHERE isodow(day) <= 5
),
own AS (SELECT ticker AS file_ticker, session_date, filename, line_no FROM trade_lines WHERE {WATCHED}),
fetched AS (
  SELECT DISTINCT 0 AS batch_id, file_ticker, session_date, filename FROM own WHERE line_no % 10 <= 3
  UNION ALL
  SELECT DISTINCT b, file_ticker, session_date, filename FROM own SEMI JOIN cal USING (session_date), (VALUES (1), (2)) v(b)
),
listed AS (
  SELECT f.batch_id, g.* FROM fetched f
       JOIN parsed g USING (file_ticker, session_date, filename)
  WHERE g.error IS NULL AND (f.batch_id > 0 OR g.line_no % 10 <= 3)
),
top AS (
  SELECT b AS batch_id, ticker, trade_date, max(trade_id) AS held
  FROM listed, (VALUES (1), (2)) v(b) WHERE "action" <> 2 AND listed.batch_id < b GROUP BY ALL
),
published AS (
  SELECT l.* FROM listed l LEFT JOIN top USING (batch_id, ticker, trade_date)
  WHERE l."action" = 2 OR l.trade_id > coalesce(held, 0)
)"""
ORACLE["backfill_ingest"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, body=SWEPT + """
SELECT batch_id, CASE batch_id WHEN 0 THEN 'intraday_poll' ELSE 'eod_file' END AS source, ticker, trade_id,
       "action", trade_date, traded_at
FROM published""")
ORACLE["fetched_files"] = with_ctes(TRADES_RAW, TRADE_LINES, PARSED_LINES, body=SWEPT + """
, last AS (
  SELECT batch_id, file_ticker, session_date, filename, count(*) AS published,
         arg_max(price, (line_no, raw_line)) AS last_price, arg_max(traded_at, (line_no, raw_line)) AS last_traded_at
  FROM published GROUP BY ALL
),
totals AS (SELECT batch_id, file_ticker, session_date, filename, count(*) AS total FROM listed GROUP BY ALL)
SELECT batch_id, file_ticker AS ticker, session_date, filename, coalesce(total, 0) AS total,
       coalesce(published, 0) AS published, last_price, last_traded_at
FROM fetched LEFT JOIN totals USING (batch_id, file_ticker, session_date, filename)
     LEFT JOIN last USING (batch_id, file_ticker, session_date, filename)""")
