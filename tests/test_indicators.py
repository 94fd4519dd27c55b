"""Numeric contract of the indicators (pandas rules) on tiny literal frames."""

import numpy as np
import pandas as pd
import pytest

from conftest import bars_frame, series_rows
from tickweave.operators import indicators as I
from tickweave.operators import signals as G


def _one(df, cols):
    return df.select("date", *cols).toPandas().sort_values("date").reset_index(drop=True)


def test_sma_null_until_n_values(spark):
    df = bars_frame(spark, series_rows("A", list(range(100, 125))))
    got = _one(I.sma(df, "close", 20), ["ma20"])
    assert got["ma20"].isna().sum() == 19
    assert got["ma20"].iloc[19] == pytest.approx(np.mean(range(100, 120)))


def test_constant_closes_std_zero_and_percent_b_missing(spark):
    df = bars_frame(spark, series_rows("A", [500] * 22))
    got = _one(I.percent_b(I.bollinger(df)), ["stddev", "upper", "lower", "pb"])
    assert got["stddev"].iloc[19:].eq(0).all()
    assert got["pb"].isna().all()


def test_bollinger_matches_pandas_and_bands_ordered(spark, bars01):
    got = I.bollinger(bars01.filter("code = 'Brand#1'")).select("date", "close", "center", "upper", "lower") \
        .toPandas().sort_values("date")
    c = got["close"].astype(float)
    np.testing.assert_allclose(got["center"], c.rolling(20).mean(), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["upper"], c.rolling(20).mean() + 2 * c.rolling(20).std(),
                               rtol=1e-12, equal_nan=True)
    ok = got.dropna()
    assert (ok["lower"] <= ok["center"]).all() and (ok["center"] <= ok["upper"]).all()


def _reference_flows(pdf):
    """Money flow as the source script computes it: integer columns, row loop."""
    tp = ((pdf.high + pdf.low + pdf.close) / 3).to_numpy()
    vol = pdf.volume.to_numpy()
    pmf = np.zeros(len(pdf), dtype=np.int64)
    nmf = np.zeros(len(pdf), dtype=np.int64)
    for i in range(len(pdf) - 1):
        if tp[i] < tp[i + 1]:
            pmf[i + 1] = tp[i + 1] * vol[i + 1]
        else:
            nmf[i + 1] = tp[i + 1] * vol[i + 1]
    return pmf, nmf


def test_money_flow_truncates_and_equal_tp_is_negative(spark):
    closes = [100, 101, 101, 103, 102, 102, 105, 104, 104, 110, 111, 112]
    rows = series_rows("A", closes, vols=[7, 3, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43])
    df = bars_frame(spark, rows)
    got = _one(I.money_flow(df), ["open", "high", "low", "close", "volume", "pmf", "nmf"])
    pmf, nmf = _reference_flows(got)
    assert list(got["pmf"]) == list(pmf) and list(got["nmf"]) == list(nmf)
    assert got["pmf"].iloc[0] == 0 and got["nmf"].iloc[0] == 0
    assert got["nmf"].iloc[2] > 0      # equal typical price counts as negative flow


def test_mfi_zero_negative_flow_is_100_and_zero_both_missing(spark):
    rising = bars_frame(spark, series_rows("A", list(range(100, 112))))
    got = _one(I.mfi(rising, 10), ["mfi10"])
    assert got["mfi10"].iloc[10] == 100.0          # ratio +inf -> 100
    flat = bars_frame(spark, series_rows("B", [100] * 12, vols=[0] * 12))
    got = _one(I.mfi(flat, 10), ["mfi10"])
    assert got["mfi10"].isna().all()               # 0/0 -> missing


def test_intraday_intensity_flat_bar_missing(spark):
    rows = [("A", "2020-01-06", 10, 10, 10, 10, 5), ("A", "2020-01-13", 10, 12, 8, 11, 5)]
    got = _one(I.intraday_intensity(bars_frame(spark, rows)), ["ii"])
    assert pd.isna(got["ii"].iloc[0])
    assert got["ii"].iloc[1] == pytest.approx((2 * 11 - 12 - 8) / (12 - 8) * 5)


def test_ii_percent_blank_frame_when_ii_missing(spark):
    closes = [100 + (i % 5) for i in range(30)]
    highs = [c + 2 for c in closes]
    lows = [c - 2 for c in closes]
    highs[24] = lows[24] = closes[24]               # one flat bar
    df = bars_frame(spark, series_rows("A", closes, highs=highs, lows=lows))
    got = _one(I.ii_percent(df, 21), ["iip21"])
    assert got["iip21"].iloc[20:24].notna().all()
    assert got["iip21"].iloc[24:].isna().all()      # every frame containing row 24


def test_macd_matches_pandas(spark, bars01):
    got = I.macd(bars01.filter("code = 'Brand#2'")).select("date", "close", "macd", "signal") \
        .toPandas().sort_values("date")
    c = got["close"].astype(float)
    line = c.ewm(span=60).mean() - c.ewm(span=130).mean()
    np.testing.assert_allclose(got["macd"], line, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(got["signal"], line.ewm(span=45).mean(), rtol=1e-9, atol=1e-9)


def test_stochastic_bounds(spark, bars01):
    got = I.stochastic(bars01).select("low", "close", "high", "fast_k").toPandas().dropna()
    inside = got[(got["low"] <= got["close"]) & (got["close"] <= got["high"])]
    assert ((inside["fast_k"] >= 0) & (inside["fast_k"] <= 100)).all()


def _reference_triple(pdf):
    """The triple-screen rule written directly in pandas for one code."""
    c = pdf["close"].astype(float)
    e60, e130 = c.ewm(span=60).mean(), c.ewm(span=130).mean()
    m = e60 - e130
    s = m.ewm(span=45).mean()
    df = pdf.assign(ema130=e130, ema60=e60, macd=m, signal=s, macdhist=m - s).dropna(
        subset=["open", "high", "low", "close", "volume"])
    hi = df["high"].astype(float).rolling(14, min_periods=1).max()
    lo = df["low"].astype(float).rolling(14, min_periods=1).min()
    k = (df["close"] - lo) / (hi - lo) * 100
    df = df.assign(fast_k=k, slow_d=k.rolling(3).mean()).replace([np.inf, -np.inf], np.nan).dropna(
        subset=["fast_k", "slow_d"])
    out = []
    e, d = df["ema130"].to_numpy(), df["slow_d"].to_numpy()
    for i in range(1, len(df)):
        if e[i - 1] < e[i] and d[i - 1] >= 20 and d[i] < 20:
            out.append((df["date"].iloc[i], "buy"))
        elif e[i - 1] > e[i] and d[i - 1] <= 80 and d[i] > 80:
            out.append((df["date"].iloc[i], "sell"))
    return out


def test_triple_screen_equals_pandas_rule(spark, bars01):
    got = G.triple_screen(bars01).select("code", "date", "trade").toPandas()
    allbars = bars01.toPandas().sort_values(["code", "date"])
    expect = []
    for code, g in allbars.groupby("code"):
        expect += [(code, d, t) for d, t in _reference_triple(g.reset_index(drop=True))]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(expect)


def test_trend_following_after_trim(spark, bars01):
    got = G.trend_following(bars01, only_signals=False).toPandas()
    per_code = got.groupby("code")["date"].count()
    full = bars01.groupBy("code").count().toPandas().set_index("code")["count"]
    assert (per_code == full.loc[per_code.index] - 19).all()
    s = got.dropna(subset=["signal"])
    assert ((s.signal == "buy") == ((s.pb > 0.8) & (s.mfi10 > 80))).all()
