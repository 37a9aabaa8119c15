"""Benchmark the headline queries.

Runs each query on $BENCH_SF_DIR (default /root/testdata/sf0.1) with local[$BENCH_CPUS],
once to warm up and then $BENCH_RUNS times (default 3), executing the full plan into
Spark's no-op sink (nothing is collected to the driver). Prints ONE JSON line:
{"metric": ..., "value": <sum of per-query medians>, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ticklake.plans.catalog import QUERIES  # noqa: E402
from ticklake.session import get_session  # noqa: E402

HEADLINE = [
    "trades_clean", "last_price", "session_summary", "pending_dividends",
    "parse_trade_lines", "cursor_filter", "ticker_documents", "dividend_radar",
    "publish_audit", "parse_cash_dividends",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app_name="ticklake-bench",
                        extra={"spark.sql.shuffle.partitions": str(max(cpus, 2))})
    out: dict[str, float] = {}
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
