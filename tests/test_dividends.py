"""Corporate actions: supplement payloads, statuses, class filter, pending rows."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticklake.operators import dividends as dv

LAYOUT = "%d/%m/%Y"


def event(**over):
    """A cash payment as the exchange lists it: agreed on a day, owed to holders ten days on, paid
    after thirty more. ``over`` replaces single fields; a field set to ... is left out."""
    agreed = over.pop("agreed", dt.date(2024, 2, 9))
    isin = over.pop("isin", "BRNOVAACNPR2")
    row = {"label": "RENDIMENTO", "isinCode": isin, "assetIssued": isin, "rate": "1,62500000000",
           "approvedOn": agreed.strftime(LAYOUT), "lastDatePrior": (agreed + dt.timedelta(10)).strftime(LAYOUT),
           "paymentDate": (agreed + dt.timedelta(40)).strftime(LAYOUT), "relatedTo": "Mensal/02-2024", "remarks": "none"}
    return {k: v for k, v in {**row, **over}.items() if v is not ...}


def split(factor, label="BONIFICACAO"):
    """A change of the number of shares."""
    row = event(label=label, factor=factor)
    return {k: v for k, v in row.items() if k not in ("rate", "paymentDate", "relatedTo")}


def _docs(spark, *bodies):
    return spark.createDataFrame([("NOVA", i, b) for i, b in enumerate(bodies)],
                                 "issuing_company string, doc_id long, body string")


def _cash(spark, *rows):
    return dv.parse_cash_rows(dv.unwrap_supplement(_docs(spark, json.dumps({"cashDividends": list(rows)}))))


#: Field of a listed payment, its text, the column it becomes, the value there.
FIELDS = [
    ("isinCode", "BRQUALACNOR4", "isin", "BRQUALACNOR4"),
    ("label", "JRS CAP PROPRIO", "label", "JRS CAP PROPRIO"),
    ("rate", "0,00000000001", "rate", Decimal("0.00000000001")),
    ("rate", "12.345,5", "rate", Decimal("12345.50000000000")),
    ("approvedOn", "29/02/2024", "approved_on", dt.date(2024, 2, 29)),
    ("lastDatePrior", "01/12/2023", "last_date_prior", dt.date(2023, 12, 1)),
    ("paymentDate", "05/03/2025", "payment_date", dt.date(2025, 3, 5)),
    ("paymentDate", "31/12/9999", "payment_date", None),
    ("relatedTo", ..., "related_to", ""),
]


def test_cash_fields(spark):
    rows = _cash(spark, *[event(**{name: text}) for name, text, _, _ in FIELDS]).orderBy("row_no").collect()
    assert [r.row_error for r in rows] == [None] * len(FIELDS)
    assert [r[column] for r, (_, _, column, _) in zip(rows, FIELDS, strict=True)] == [v for *_, v in FIELDS]


def test_stock_factors(spark):
    texts = {"0,5": Decimal("0.5"), "1.000,25": Decimal("1000.25"), "7": Decimal(7)}
    docs = _docs(spark, json.dumps({"stockDividends": [split(t) for t in texts]}))
    rows = dv.parse_stock_rows(dv.unwrap_supplement(docs)).orderBy("row_no").collect()
    assert [r.factor for r in rows] == list(texts.values())
    assert {r.label for r in rows} == {"BONIFICACAO"}


def test_bad_rows_are_errors_of_their_own(spark):
    bad = [{"label": "x"}, event(rate="much"), event(approvedOn="2024-02-09")]
    body = {"cashDividends": [event(), *bad], "stockDividends": [split("2,0"), split("?")]}
    u = dv.unwrap_supplement(_docs(spark, json.dumps(body)))
    assert dv.parse_cash_rows(u).filter("row_error IS NULL").count() == 1
    assert dv.parse_stock_rows(u).filter("row_error IS NULL").count() == 1
    assert dv.supplement_errors(u).count() == len(bad) + 1


@pytest.mark.parametrize("error, bodies", [
    ("empty body", [""]), ("non-JSON body", ["<p>try later</p>", "{oops"]), ("empty supplement", ["{}", "[]"]),
])
def test_unusable_bodies(spark, error, bodies):
    assert [r.doc_error for r in dv.unwrap_supplement(_docs(spark, *bodies)).collect()] == [error] * len(bodies)


def test_a_list_of_one_is_its_document(spark):
    u = dv.unwrap_supplement(_docs(spark, json.dumps([{"cashDividends": [event(), event()]}]))).first()
    assert (u.doc_error, len(u.cash), u.stock) == (None, 2, [])


@pytest.mark.parametrize("paid, today, status", [
    ("20/03/2024", "2024-02-19", "with_rights"),      # the last day that earns it
    ("20/03/2024", "2024-02-20", "pending_payment"),
    ("20/03/2024", "2024-03-19", "pending_payment"),
    ("20/03/2024", "2024-03-20", "paid"),             # on the day of payment
    ("12/02/2024", "2024-02-15", "with_rights"),      # even where it was paid before
    ("31/12/9999", "2031-01-01", "pending_payment"),  # no day is set
])
def test_status(spark, paid, today, status):
    day = F.lit(today).cast("date")
    rows = _cash(spark, event(paymentDate=paid))
    assert rows.select(dv.status_full(F.col("last_date_prior"), F.col("payment_date"), day)).first()[0] == status


def test_share_classes(spark):
    pairs = {("BRNOVAACNPR2", "NOVA4"): True, ("BRNOVAACNOR5", "NOVA4"): False, ("BRQUALACNOR4", "QUAL3"): True,
             ("BRQUALACNPR1", "QUAL3"): False, ("BRZETAACNOR8", "ZETA11"): False}
    df = spark.createDataFrame(list(pairs), "isin string, ticker string")
    got = df.select("*", dv.isin_matches_ticker(F.col("isin"), F.col("ticker")).alias("same")).collect()
    assert {(r.isin, r.ticker): r.same for r in got} == pairs


def test_the_last_ticker_of_an_issuer_counts(spark):
    wl = spark.createDataFrame([("NOVA4", "NOVA", 7), ("NOVA3", "NOVA", 2)],
                               "ticker string, issuing_company string, position int")
    assert dv.issuer_tickers(wl).first().ticker == "NOVA4"


def _pending(spark, label="RENDIMENTO", paid=dt.date(2024, 3, 20), price="26.000"):
    cash = spark.createDataFrame(
        [("NOVA4", "BRNOVAACNPR2", label, Decimal("1.62500000000"), dt.date(2024, 2, 9), dt.date(2024, 2, 19), paid, "",
          dt.datetime(2024, 3, 1))],
        "ticker string, isin string, label string, rate decimal(20,11), approved_on date, "
        "last_date_prior date, payment_date date, related_to string, synced_at timestamp_ntz")
    lp = spark.createDataFrame([("NOVA4", Decimal(price), dt.datetime(2024, 3, 1, 17, 5, 9))],
                               "ticker string, price decimal(18,3), traded_at timestamp_ntz")
    return dv.pending(cash, lp, "2024-03-04 15:00:00").collect()


def test_interest_on_capital_is_shown_net(spark):
    [r] = _pending(spark, label="JRS CAP PROPRIO")
    assert Decimal(r.net_per_share) * 100 == Decimal(r.gross_per_share) * 85
    assert (r.gross_per_share, r.net_per_share) == ("1.62500000000", "1.3812500000000")  # 11 and 13 decimals
    assert r.status == "pending_payment" and "15%" in r.tax_note


def test_other_payments_are_shown_as_they_are(spark):
    [r] = _pending(spark)
    assert r.net_per_share == r.gross_per_share == "1.62500000000" and "exempt" in r.tax_note
    assert r.yield_on_last_price == 0.0625  # 1.625 / 26
    assert (r.last_price, r.price_as_of, r.buy_by) == ("26.000", "2024-03-01T17:05:09+00:00", "2024-02-19")


def test_pending_edges(spark):
    [open_end] = _pending(spark, paid=None)
    assert open_end.payment_tbd is True and open_end.payment_date is None
    [worthless] = _pending(spark, price="0.000")
    assert worthless.yield_on_last_price is None
    assert _pending(spark, paid=dt.date(2024, 3, 4)) == []  # paid today


def test_errors_come_from_one_decode(spark):
    docs = _docs(spark, json.dumps({"cashDividends": [event(), {"rate": "1"}], "stockDividends": [{"factor": "x"}]}), "")
    errors = dv.supplement_errors(dv.unwrap_supplement(docs))
    plan = errors._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and "Union" not in plan
    assert sorted((r.row_no is None, r.row_no, r.error.split(":")[0]) for r in errors.collect()) == [
        (False, 0, "bad stock dividend row"), (False, 1, "bad cash dividend row"), (True, None, "empty body")]


def test_dates_are_read_as_the_formatter_reads_them(spark):
    from pyspark.sql import functions as F

    from ticklake.functions.timefmt import br_date, iso_date
    days = [f"{d}/{m}/{y}" for y in ("2023", "2024", "0000", "1582", "9999") for m in ("0", "1", "02", "2", "4", "12", "13")
            for d in ("0", "00", "1", "01", "05", "28", "29", "30", "31", "32")] + ["", "1/2", "1/2/24", " 1/2/2024", "1/2/2024 ", "a/b/cccc", None]
    isos = ["{2}-{1:0>2}-{0:0>2}".format(*d.split("/")) for d in days if d and d.count("/") == 2] + ["2024-1-01", "2024-01-01 ", "20240230", "20240229"]
    df = spark.createDataFrame([(x,) for x in days + isos], "t string")
    t = F.col("t")
    got = df.select("t", br_date(t).cast("string").alias("br"), iso_date(t).cast("string").alias("iso"),
                    F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(t, "d/M/yyyy")).cast("string").alias("br0"),
                    F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))
                     .when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")).cast("string").alias("iso0")).collect()
    assert [r for r in got if (r.br, r.iso) != (r.br0, r.iso0)] == []
