"""Series windows must equal pandas over whole series of any length."""

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import bars_frame, series_rows
from tickweave.functions import series as S
from tickweave.operators import indicators as I
from tickweave.operators import signals as G


def _closes(n, seed, gaps=()):
    rng = np.random.default_rng(seed)
    vals = list(np.round(1000 + np.cumsum(rng.normal(0, 20, n))).astype(int))
    for g in gaps:
        vals[g] = None
    return [None if v is None else int(v) for v in vals]


@pytest.fixture(scope="module")
def two_codes(spark):
    rows = series_rows("A", _closes(150, 1, gaps=(40, 41, 97))) + series_rows("B", _closes(37, 2))
    return bars_frame(spark, rows)


def _pd(df, cols):
    return df.select("code", "date", *cols).toPandas().sort_values(["code", "date"]).reset_index(drop=True)


def test_open_series_numbers_rows_per_code(two_codes):
    seq = S.open_series(two_codes).select("code", "date", "_rn").toPandas()
    for code, g in seq.groupby("code"):
        g = g.sort_values("date")
        assert list(g["_rn"]) == list(range(len(g)))
    assert "_rn" not in S.finish(S.open_series(two_codes)).columns


def test_rolling_and_lag(two_codes):
    s = S.open_series(two_codes)
    s = (s.withColumn("m", S.rolling(F.col("close").cast("double"), 6, F.avg))
          .withColumn("mx", S.rolling(F.col("high").cast("double"), 4, F.max, min_periods=1))
          .withColumn("p", S.lag("close")))
    got = _pd(S.finish(s), ["close", "high", "m", "mx", "p"])
    for code, g in got.groupby("code"):
        c = g["close"].astype(float)
        np.testing.assert_allclose(g["m"].astype(float), c.rolling(6).mean(), equal_nan=True)
        np.testing.assert_allclose(g["mx"].astype(float), g["high"].astype(float).rolling(4, min_periods=1).max(),
                                   equal_nan=True)
        np.testing.assert_allclose(g["p"].astype(float), c.shift(1), equal_nan=True)


def _long_series(spark, values):
    start = dt.date(1900, 1, 1)
    rows = [("A", start + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "code string, date date, close double")


@pytest.mark.parametrize("case", ["dense", "gaps", "long gap", "sparse", "leading gap"])
def test_ewm_of_a_long_series_matches_pandas(spark, case):
    """Spans 1 to 130 over 7,000 rows, gaps of 2,500 rows among them."""
    rng = np.random.default_rng(4)
    x = 100 + np.cumsum(rng.normal(0, 1, 7000))
    if case == "gaps":
        x[rng.random(7000) < 0.3] = np.nan
    elif case == "long gap":
        x[1000:3500] = np.nan
        x[3501:6200] = np.nan
    elif case == "sparse":
        keep = rng.choice(7000, 6, replace=False)
        x = np.where(np.isin(np.arange(7000), keep), x, np.nan)
    elif case == "leading gap":
        x[:2600] = np.nan
    df = _long_series(spark, [None if np.isnan(v) else v for v in x])
    spans = (1, 1.5, 2, 5, 60, 130)
    s = S.ewm_many(S.open_series(df), [("close", sp, f"e{i}") for i, sp in enumerate(spans)])
    got = _pd(S.finish(s), [f"e{i}" for i in range(len(spans))])
    for i, sp in enumerate(spans):
        want = pd.Series(x).ewm(span=sp).mean()
        np.testing.assert_allclose(got[f"e{i}"].astype(float), want, rtol=1e-9, equal_nan=True, err_msg=f"span {sp}")


def test_ewm_of_an_operator_is_numbered_for_itself(two_codes):
    got = _pd(I.ewm(two_codes, span=1), ["close", "ema1"])
    for code, g in got.groupby("code"):
        np.testing.assert_allclose(g["ema1"].astype(float), g["close"].astype(float).ewm(span=1).mean(), equal_nan=True)


def test_forward_fill(two_codes):
    got = _pd(S.forward_fill(two_codes, "close", "ff"), ["close", "ff"])
    for code, g in got.groupby("code"):
        np.testing.assert_allclose(g["ff"].astype(float), g["close"].astype(float).ffill(), equal_nan=True)


def test_windows_after_a_filter_see_what_is_left(two_codes):
    kept = S.open_series(two_codes).filter(F.col("close").isNotNull()).withColumn("p", S.lag("close"))
    got = _pd(S.finish(kept), ["close", "p"])
    for code, g in got.groupby("code"):
        np.testing.assert_allclose(g["p"].astype(float), g["close"].astype(float).shift(1), equal_nan=True)


def test_result_independent_of_input_partitioning(two_codes):
    a = S.finish(S.ewm_mean(S.open_series(two_codes.repartition(7)), "close", 20, "e"))
    b = S.finish(S.ewm_mean(S.open_series(two_codes.coalesce(1)), "close", 20, "e"))
    pd.testing.assert_frame_equal(_pd(a, ["e"]), _pd(b, ["e"]))


def test_one_plan_for_every_length(spark, two_codes):
    """The triple screen of 30 rows a code and of 30,000 has one exchange and one plan."""
    def plan(df):
        text = G.triple_screen(df)._jdf.queryExecution().executedPlan().toString()
        return re.sub(r"#\d+L?|plan_id=\d+|Scan ExistingRDD|\[.*?\]", "", text)
    day = F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") / 3).cast("int"))
    days = spark.range(90_000).select((F.col("id") % 3).cast("string").alias("code"), day.alias("date"), "id")
    long = days.select("code", "date", *[(F.col("id") % 97 + k).alias(c) for k, c in enumerate(("open", "high", "low", "close", "volume"))])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        short, whole = plan(long.where("date < '1900-01-31'")), plan(long)
        assert len(re.findall(r"Exchange hashpartitioning", whole)) == 1
        assert short.count("Window") == whole.count("Window") and "Join" not in whole
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
