"""Technical indicators over bars of all securities at once.

Each operator takes a bars DataFrame and adds columns.  Given a plain frame
it numbers the rows itself (``series.open_series``) and returns a plain frame;
given a numbered frame it adds columns in place, so a stack of indicators
shares one numbering and one shuffle.  Numeric rules follow pandas: rolling windows
are NULL until ``n`` valid values are in the frame, x/0 is NULL (never an
ANSI error), std is the sample std.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import series as S


def _apply(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return fn(df) if S.is_open(df) else S.finish(fn(S.open_series(df)))


def _d(name: str):
    return F.col(name).cast("double")


def sma(df: DataFrame, col: str = "close", n: int = 20, out: str | None = None) -> DataFrame:
    """W1 rolling mean."""
    out = out or f"ma{n}"
    return _apply(df, lambda s: s.withColumn(out, S.rolling(_d(col), n, F.avg)))


def rolling_std(df: DataFrame, col: str = "close", n: int = 20, out: str = "stddev") -> DataFrame:
    """W2 rolling sample standard deviation (ddof=1)."""
    return _apply(df, lambda s: s.withColumn(out, S.rolling(_d(col), n, F.stddev_samp)))


def bollinger(df: DataFrame, n: int = 20, sigma: float = 2.0, col: str = "close") -> DataFrame:
    """center = SMA(n), upper/lower = center ± sigma·std(n)."""
    def fn(s):
        s = s.withColumn("center", S.rolling(_d(col), n, F.avg))
        s = s.withColumn("stddev", S.rolling(_d(col), n, F.stddev_samp))
        return (s.withColumn("upper", F.col("center") + F.col("stddev") * F.lit(float(sigma)))
                 .withColumn("lower", F.col("center") - F.col("stddev") * F.lit(float(sigma))))
    return _apply(df, fn)


def percent_b(df: DataFrame, col: str = "close") -> DataFrame:
    """W4 (close - lower) / (upper - lower); zero band width -> NULL."""
    return df.withColumn("pb", F.try_divide(_d(col) - F.col("lower"), F.col("upper") - F.col("lower")))


def bandwidth(df: DataFrame) -> DataFrame:
    """Band width (upper - lower) / center.  Extension: not a source operator."""
    return df.withColumn("bandwidth", F.try_divide(F.col("upper") - F.col("lower"), F.col("center")))


def typical_price(df: DataFrame) -> DataFrame:
    """W5 (high + low + close) / 3, in double."""
    return df.withColumn("tp", (_d("high") + _d("low") + _d("close")) / F.lit(3.0))


def money_flow(df: DataFrame, truncate: bool = True) -> DataFrame:
    """W6 positive / negative money flow.

    Rising typical price -> PMF = TP·VOL, NMF = 0; otherwise (equal too) the
    reverse; the first row of a security has both 0.  The flows are written
    into integer columns, so they are truncated toward zero (``truncate``).
    """
    def fn(s):
        if "tp" not in s.columns:
            s = typical_price(s)
        flow = F.col("tp") * _d("volume")
        if truncate:
            flow = flow.cast("bigint")
        prev = S.lag("tp")
        up = prev < F.col("tp")
        first = prev.isNull() & (S.row_position() == 0)
        zero = F.lit(0).cast("bigint") if truncate else F.lit(0.0)
        return (s.withColumn("pmf", F.when(first, zero).when(up, flow).otherwise(zero))
                 .withColumn("nmf", F.when(first, zero).when(up, zero).otherwise(flow)))
    return _apply(df, fn)


def mfi(df: DataFrame, n: int = 10) -> DataFrame:
    """W7 money flow index: 100 - 100 / (1 + ΣPMF/ΣNMF) over n rows.

    ΣNMF = 0 gives 100 when ΣPMF > 0 (ratio +inf) and NULL when both are 0.
    """
    def fn(s):
        if "pmf" not in s.columns:
            s = money_flow(s)
        p = S.rolling(_d("pmf"), n, F.sum)
        q = S.rolling(_d("nmf"), n, F.sum)
        val = (F.when(q == 0, F.when(p > 0, F.lit(100.0)))
                .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + p / q)))
        return s.withColumn(f"mfi{n}", val)
    return _apply(df, fn)


def intraday_intensity(df: DataFrame) -> DataFrame:
    """W8 (2C - H - L) / (H - L) · VOL; high = low -> NULL."""
    num = F.lit(2.0) * _d("close") - _d("high") - _d("low")
    return df.withColumn("ii", F.try_divide(num, _d("high") - _d("low")) * _d("volume"))


def ii_percent(df: DataFrame, n: int = 21) -> DataFrame:
    """W9 ΣII / ΣVOL · 100 over n rows; a missing II blanks the whole frame."""
    def fn(s):
        if "ii" not in s.columns:
            s = intraday_intensity(s)
        num = S.rolling(F.col("ii"), n, F.sum)
        den = S.rolling(_d("volume"), n, F.sum)
        return s.withColumn(f"iip{n}", F.try_divide(num, den) * F.lit(100.0))
    return _apply(df, fn)


def ewm(df: DataFrame, col: str = "close", span: float = 60, out: str | None = None) -> DataFrame:
    """W10 exponentially weighted mean (pandas adjust=True, ignore_na=False)."""
    out = out or f"ema{int(span)}"
    return _apply(df, lambda s: S.ewm_mean(s, col, span, out))


def macd(df: DataFrame, fast: int = 60, slow: int = 130, signal: int = 45,
         col: str = "close") -> DataFrame:
    """W11 MACD line = EMA(fast) - EMA(slow); signal = EMA(signal) of the line."""
    def fn(s):
        s = S.ewm_many(s, [(col, fast, f"ema{fast}"), (col, slow, f"ema{slow}")])
        s = s.withColumn("macd", F.col(f"ema{fast}") - F.col(f"ema{slow}"))
        s = S.ewm_mean(s, "macd", signal, "signal")
        return s.withColumn("macdhist", F.col("macd") - F.col("signal"))
    return _apply(df, fn)


def stochastic(df: DataFrame, n: int = 14, d: int = 3) -> DataFrame:
    """N-row high/low (min_periods=1), fast %K, slow %D = mean of d %K."""
    def fn(s):
        s = (s.withColumn("ndays_high", S.rolling(_d("high"), n, F.max, min_periods=1))
              .withColumn("ndays_low", S.rolling(_d("low"), n, F.min, min_periods=1)))
        fast_k = F.try_divide(_d("close") - F.col("ndays_low"),
                              F.col("ndays_high") - F.col("ndays_low")) * F.lit(100.0)
        s = s.withColumn("fast_k", fast_k)
        return s.withColumn("slow_d", S.rolling(F.col("fast_k"), d, F.avg))
    return _apply(df, fn)
