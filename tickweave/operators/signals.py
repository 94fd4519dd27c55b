"""Trade signals and the triple-screen bundles.

Each function runs a whole indicator stack for all securities after one
shuffle on the code; a ``dropna`` between windows filters in place, so later
frames and lags see surviving rows only, as the source scripts do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import series as S
from ..schemas import PRICE_COLS
from . import indicators as I

SIGNAL_TYPE = "string"


def _price_cols(df: DataFrame) -> list[str]:
    return [c for c in PRICE_COLS if c in df.columns]


def drop_first(df: DataFrame, n: int) -> DataFrame:
    """P8/C9 ``df[n:]``: drop the first n rows of each security's range."""
    return df.filter(S.row_position() >= n)


def trend_following(bars: DataFrame, n: int = 20, sigma: float = 2.0, mfi_n: int = 10,
                    buy_pb: float = 0.8, buy_mfi: float = 80.0,
                    sell_pb: float = 0.2, sell_mfi: float = 20.0,
                    only_signals: bool = True) -> DataFrame:
    """W17 Bollinger %B + MFI: buy on %B > 0.8 and MFI > 80, sell on %B < 0.2 and MFI < 20,
    after the first n-1 rows are dropped."""
    s = S.open_series(bars)
    s = I.percent_b(I.bollinger(s, n, sigma))
    s = I.mfi(I.money_flow(I.typical_price(s)), mfi_n)
    s = drop_first(s, n - 1)
    m = F.col(f"mfi{mfi_n}")
    sig = (F.when((F.col("pb") > buy_pb) & (m > buy_mfi), F.lit("buy"))
            .when((F.col("pb") < sell_pb) & (m < sell_mfi), F.lit("sell")))
    out = S.finish(s.withColumn("signal", sig))
    return out.filter(F.col("signal").isNotNull()) if only_signals else out


def reversal(bars: DataFrame, n: int = 20, sigma: float = 2.0, ii_n: int = 21,
             buy_pb: float = 0.05, sell_pb: float = 0.95, only_signals: bool = True) -> DataFrame:
    """W18 Bollinger %B + II%: after dropna, buy on %B < 0.05 and II% > 0,
    sell on %B > 0.95 and II% < 0."""
    s = S.open_series(bars)
    s = I.percent_b(I.bollinger(s, n, sigma))
    s = I.ii_percent(I.intraday_intensity(s), ii_n)
    s = S.finish(s)
    iip = f"iip{ii_n}"
    s = s.dropna(how="any", subset=_price_cols(s) + ["center", "stddev", "upper", "lower", "pb", "ii", iip])
    sig = (F.when((F.col("pb") < buy_pb) & (F.col(iip) > 0), F.lit("buy"))
            .when((F.col("pb") > sell_pb) & (F.col(iip) < 0), F.lit("sell")))
    out = s.withColumn("signal", sig)
    return out.filter(F.col("signal").isNotNull()) if only_signals else out


FIRST_SCREEN_COLS = ["ema130", "ema60", "macd", "signal", "macdhist"]


def _first_screen(bars: DataFrame, fast: int, slow: int, signal: int) -> DataFrame:
    s = S.open_series(bars)
    s = I.macd(s, fast, slow, signal)
    if fast != 60 or slow != 130:
        s = s.withColumnRenamed(f"ema{fast}", "ema60").withColumnRenamed(f"ema{slow}", "ema130")
    return s.dropna(how="any", subset=_price_cols(s) + FIRST_SCREEN_COLS)


def first_screen(bars: DataFrame, fast: int = 60, slow: int = 130, signal: int = 45) -> DataFrame:
    """W20 MACD set on close, dropna, the columns a candlestick chart needs."""
    return S.finish(_first_screen(bars, fast, slow, signal))


def _second_screen(bars: DataFrame, fast: int, slow: int, signal: int,
                   n: int, d: int) -> DataFrame:
    s = _first_screen(bars, fast, slow, signal)
    s = I.stochastic(s, n, d)
    return s.dropna(how="any", subset=_price_cols(s) + FIRST_SCREEN_COLS
                    + ["ndays_high", "ndays_low", "fast_k", "slow_d"])


def second_screen(bars: DataFrame, fast: int = 60, slow: int = 130, signal: int = 45,
                  n: int = 14, d: int = 3) -> DataFrame:
    """W21 first screen, then the n-row stochastic (computed on the rows the
    first dropna kept), then dropna again."""
    return S.finish(_second_screen(bars, fast, slow, signal, n, d))


def triple_screen(bars: DataFrame, fast: int = 60, slow: int = 130, signal: int = 45,
                  n: int = 14, d: int = 3, low: float = 20.0, high: float = 80.0,
                  only_signals: bool = True) -> DataFrame:
    """W19 on the rows left by the second screen: buy when EMA130 rises and
    slow %D crosses down through 20; sell when EMA130 falls and slow %D
    crosses up through 80 (previous surviving row vs this one)."""
    s = _second_screen(bars, fast, slow, signal, n, d)
    pe, ps = S.lag("ema130"), S.lag("slow_d")
    e, sd = F.col("ema130"), F.col("slow_d")
    sig = (F.when((pe < e) & (ps >= low) & (sd < low), F.lit("buy"))
            .when((pe > e) & (ps <= high) & (sd > high), F.lit("sell")))
    out = S.finish(s.withColumn("trade", sig))
    return out.filter(F.col("trade").isNotNull()) if only_signals else out


def chart_frame(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """W22 the columns a price chart draws (OHLC, bands, volume when present)."""
    wanted = cols or ["code", "date", "open", "high", "low", "close", "volume",
                      "center", "upper", "lower", "ema130", "macd", "signal", "macdhist"]
    return df.select(*[c for c in wanted if c in df.columns])
