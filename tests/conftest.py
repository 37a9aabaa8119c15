from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ticklake.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Tests own their scratch space; on a cluster spark.checkpoint.dir is set by the deployment.
    ckpt = tempfile.mkdtemp(prefix="ticklake-test-ckpt-")
    s = get_session("local[*]", app_name="ticklake-tests",
                    extra={"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def lines_df(spark):
    """Build a trade-line DataFrame with file context, like a landed file."""
    def make(lines, ticker="PETR4", session="2026-07-14",
             filename="14-07-2026_NEGOCIOSAVISTA_PETR4_1046.txt"):
        rows = [(ticker, session, filename, "intraday_poll", i, line) for i, line in enumerate(lines)]
        return spark.createDataFrame(
            rows, "file_ticker string, session_date string, filename string, source string, "
                  "line_no long, raw_line string").withColumn(
            "session_date", __import__("pyspark.sql.functions", fromlist=["col"]).col("session_date").cast("date"))
    return make
