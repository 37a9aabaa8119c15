"""Plan shape: the physical plans the scale design relies on."""

from __future__ import annotations

import contextlib
import io

from ticklake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(df) -> str:
    """Just the operator tree of the formatted plan (node details follow a blank line)."""
    return plan(df).split("\n\n")[0]


def test_session_summary_is_hash_aggregated_and_pruned(spark):
    p = plan(QUERIES["session_summary"](spark, SF))
    assert "SortAggregate" not in p and "HashAggregate" in p
    assert "l_discount" not in p and "l_tax" not in p          # column pruning reaches the scan
    assert "Window" not in p


def test_last_price_has_no_window_and_no_sort(spark):
    p = tree(QUERIES["last_price"](spark, SF))
    assert "Window" not in p
    # the per-session arg-max over all trades is hash aggregated; only the per-ticker
    # stage over one row per session (partial + final) may be sort based
    assert p.count("HashAggregate") >= 2 and p.count("SortAggregate") <= 2


def test_trades_clean_combines_map_side(spark):
    p = plan(QUERIES["trades_clean"](spark, SF))
    assert "partial_max" in p  # partial aggregation before the shuffle


def test_optional_ticker_filter_reaches_both_join_sides(spark):
    p = plan(QUERIES["pending_dividends_one"](spark, SF))
    assert p.count("= TK04") >= 2 or p.count("TK04") >= 2


def test_pending_join_becomes_broadcast_at_runtime(spark):
    df = QUERIES["pending_dividends"](spark, SF)
    df.collect()
    p = plan(df)
    assert "isFinalPlan=true" in p and "BroadcastHashJoin" in p


def test_parse_has_no_python_udf_in_hot_path(spark):
    p = plan(QUERIES["parse_trade_lines"](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scalar_subquery_instead_of_cross_join(spark):
    p = plan(QUERIES["dividend_radar"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Subquery" in p
