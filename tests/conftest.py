import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]").appName("tickweave-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only when the environment names none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tickweave-test-"))
    yield s


@pytest.fixture(scope="session")
def bars01(spark):
    from tickweave.sources import fixtures as X
    return X.stored_bars(spark, SF01)


def bars_frame(spark, rows, codes=None):
    """Literal bars: rows of (code, date 'yyyy-mm-dd', open, high, low, close, volume)."""
    import datetime as dt
    from pyspark.sql import functions as F

    from tickweave.schemas import BARS
    data = []
    for r in rows:
        code, d, o, h, l, c, v = r
        data.append((code, dt.date.fromisoformat(d), d.replace("-", ""), o, h, l, c, None, v, None, None))
    df = spark.createDataFrame(data, BARS)
    return df.drop("reg_dt", "upd_dt").withColumn("diff", F.col("diff").cast("bigint"))


def series_rows(code, closes, start="2020-01-06", step_days=7, highs=None, lows=None, vols=None):
    import datetime as dt
    d0 = dt.date.fromisoformat(start)
    out = []
    for i, c in enumerate(closes):
        h = highs[i] if highs else (None if c is None else c + 2)
        low = lows[i] if lows else (None if c is None else c - 2)
        v = vols[i] if vols else 100 + i
        out.append((code, (d0 + dt.timedelta(days=step_days * i)).isoformat(), c, h, low, c, v))
    return out
