"""Time-series windows over bars of all securities.

One layout for every size: a security is one window partition, ordered by
date, and a whole stack of windows shares the one exchange on its key.  Bars
are keyed by (code, date), so a partition grows with the calendar — at most
366 rows a year — and never with the number of securities or trades.

``open_series`` adds the row position ``_rn``; ``finish`` drops it.  A filter
between the two (``dropna``) leaves the partitioning as it is: later windows
see the rows that are left, with no further exchange.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HELPERS = ("_rn",)
#: An EWM block holds so many rows that what lies before the preceding block weighs less than e^-45 of a
#: block's own rows, and at most eight times as many, so that the weights within it stay below e^360.
_LEAST_DECAY = 45.0
_BLOCK_BASE = 8


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def series_window(keys: Sequence[str] | str = ("code",), order: str = "date"):
    return Window.partitionBy(*_keys(keys)).orderBy(order)


def open_series(df: DataFrame, keys: Sequence[str] | str = ("code",), order: str = "date") -> DataFrame:
    """Add ``_rn``: 0-based position of each row within ``keys`` by ``order``.

    ``order`` must be unique within a key (it is: bars are keyed by code, date).
    """
    return df.withColumn("_rn", (F.row_number().over(series_window(keys, order)) - 1).cast("bigint"))


def is_open(df: DataFrame) -> bool:
    return "_rn" in df.columns


def finish(df: DataFrame) -> DataFrame:
    """Drop helper columns."""
    return df.drop(*HELPERS)


def rolling(col: Column | str, n: int, agg, keys=("code",), min_periods: int | None = None, order: str = "date") -> Column:
    """pandas ``rolling(window=n, min_periods=...)``: NULL until enough valid values."""
    c = F.col(col) if isinstance(col, str) else col
    w = series_window(keys, order).rowsBetween(-(n - 1), 0)
    value = agg(c).over(w)
    need = n if min_periods is None else min_periods
    if need <= 1:
        return value
    return F.when(F.count(c).over(w) >= need, value)


def lag(col: Column | str, k: int = 1, keys=("code",), order: str = "date") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.lag(c, k).over(series_window(keys, order))


def row_position() -> Column:
    """0-based position of the row within its security (after ``open_series``)."""
    return F.col("_rn")


def ewm_mean(df: DataFrame, col: str, span: float, out: str,
             keys: Sequence[str] | str = ("code",), order: str = "date") -> DataFrame:
    """pandas ``ewm(span=span, adjust=True, ignore_na=False).mean()``; see ``ewm_many``."""
    return ewm_many(df, [(col, span, out)], keys, order)


def ewm_block(span: float) -> int:
    """Rows of an EWM block: the least power of eight over which a weight falls by e^-45.

    Spans of like size share a length (60, 130 and 45 all take 4,096 rows), and
    with it one sort order and one set of window operators.
    """
    rows = 1
    while rows * decay(span) < _LEAST_DECAY:
        rows *= _BLOCK_BASE
    return rows


def decay(span: float) -> float:
    """-log of the weight that a value loses a row."""
    return -math.log1p(-2.0 / (span + 1.0))


def ewm_many(df: DataFrame, specs: Sequence[tuple[str, float, str]],
             keys: Sequence[str] | str = ("code",), order: str = "date") -> DataFrame:
    """Several exponentially weighted means ``(col, span, out)`` over one numbering.

    y_t = sum_{i<=t} q^(t-i) x_i / sum_{i<=t, x_i valid} q^(t-i), q = 1 - 2/(span+1).

    Running sums with weights q^-j would overflow on a long series, so positions
    are cut into blocks (``ewm_block``).  A row with a value adds its own block's
    running sums to the sums of the block before; beside the value itself,
    everything older is below the rounding of a double.  A row without a value
    takes the mean of the last row that has one, as pandas carries it through
    any run of missing values.  A row holds two numbers a block, whatever the
    length of the series, and the blocks stay inside the security's window
    partition: no exchange, no join.
    """
    keys = _keys(keys)
    for _, span, _ in specs:
        if span < 1:
            raise ValueError(f"span {span} must be at least 1")
    out = df
    for rows in sorted({ewm_block(span) for _, span, _ in specs if span > 1}):
        out = _ewm_blocks(out, [s for s in specs if s[1] > 1 and ewm_block(s[1]) == rows], rows, keys, order)
    last = series_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    ones = {name: F.last(F.col(col).cast("double"), ignorenulls=True).over(last) for col, span, name in specs if span == 1}
    out = out.withColumns(ones) if ones else out
    return out.select(*df.columns, *[name for _, _, name in specs if name not in df.columns])


def _ewm_blocks(df: DataFrame, specs: Sequence[tuple[str, float, str]], rows: int, keys: list[str], order: str) -> DataFrame:
    """The means of specs that share one block length."""
    block = f"_block{rows}"
    df = df.withColumn(block, F.expr(f"_rn DIV {rows}"))
    j = (F.col("_rn") - F.col(block) * rows).cast("double")
    # one sort order (keys, block, order) serves all three windows
    own = Window.partitionBy(*keys, block).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(block).rangeBetween(-1, -1)
    whole = Window.partitionBy(*keys).orderBy(block, order).rowsBetween(Window.unboundedPreceding, 0)
    sums, old, means = {}, {}, {}
    for i, (col, span, out) in enumerate(specs):
        lnq, x = decay(span), F.col(col).cast("double")
        up, from_end = F.exp(j * lnq), F.exp((j - (rows - 1)) * lnq)
        there = x.isNotNull()
        sums |= {f"_n{i}": F.sum(F.when(there, x * up)).over(own), f"_d{i}": F.sum(F.when(there, up)).over(own)}
        old |= {f"_m{i}": F.sum(F.when(there, x * from_end)).over(before), f"_w{i}": F.sum(F.when(there, from_end)).over(before)}
        down, past = F.exp(-j * lnq), F.exp(-(j + 1) * lnq)
        num = F.col(f"_n{i}") * down + F.coalesce(F.col(f"_m{i}") * past, F.lit(0.0))
        den = F.col(f"_d{i}") * down + F.coalesce(F.col(f"_w{i}") * past, F.lit(0.0))
        means[out] = F.last(F.when(there, num / den), ignorenulls=True).over(whole)
    df = df.withColumns(sums).withColumns(old)
    return df.withColumns(means).drop(block, *sums, *old)


def forward_fill(df: DataFrame, col: str, out: str,
                 keys: Sequence[str] | str = ("code",), order: str = "date") -> DataFrame:
    """Last non-null value at or before each row (pandas ``ffill``)."""
    run = series_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(F.col(col), ignorenulls=True).over(run))
