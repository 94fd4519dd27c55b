"""Relative and absolute momentum.

The source runs 2 selects per code plus 2 for the dates; here the whole
ranking is one job: the requested dates snap to trading days by lookups that
read a year each, the bars of those two days are read (a filter that prunes
to their years), one conditional aggregate per code gives both prices, and a
``TakeOrderedAndProject`` gives the top k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.market import attach_names


def asof_trading_day(bars: DataFrame, day: str) -> Column:
    """J4/A4 latest bar date on or before ``day`` across the whole table; NULL where there is none.

    The day is looked up when the plan is built, so that scans on it prune by a
    known year.  On year-partitioned bars the lookup reads the requested year
    alone, and where that has no day early enough, the newest year before it
    (known from the partition values).
    """
    def newest(rows: DataFrame, col: str = "date"):
        return rows.agg(F.max(col)).first()[0]

    upto = bars.filter(F.col("date") <= F.lit(day).cast("date"))
    if "year" not in bars.columns:
        return F.lit(newest(upto)).cast("date")
    year = int(day[:4])
    found = newest(upto.filter(F.col("year") == year))
    if found is None:
        earlier = newest(bars.select("year").filter(F.col("year") < year), "year")
        found = newest(bars.filter(F.col("year") == earlier)) if earlier is not None else None
    return F.lit(found).cast("date")


def asof_days(requested: DataFrame, bars: DataFrame, col: str = "requested") -> DataFrame:
    """J4 for a table of dates: latest trading day on or before each requested date.

    Trading days and requested dates are unioned and scanned per calendar
    year (a group holds at most 366 + 366 rows); a requested date early in a
    year takes the last trading day of earlier years from a small per-year
    table.  Dates with no trading day before them are dropped.
    """
    days = bars.select(F.col("date").alias("d")).distinct().withColumn("_t", F.col("d"))
    req = requested.select(F.col(col).cast("date").alias("d")).distinct() \
                   .withColumn("_t", F.lit(None).cast("date"))
    u = days.unionByName(req).withColumn("_y", F.year("d")) \
            .withColumn("_req", F.col("_t").isNull())
    within = Window.partitionBy("_y").orderBy("d", F.col("_req").asc()) \
                   .rowsBetween(Window.unboundedPreceding, 0)
    # one row per calendar year that holds a trading or a requested date (years
    # without trading days included), so the global frame over it is small
    per_year = u.groupBy("_y").agg(F.max("_t").alias("_last"))
    before = Window.orderBy("_y").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_year.select("_y", F.max("_last").over(before).alias("_carry"))
    out = (u.withColumn("_hit", F.max("_t").over(within))
            .filter("_req")
            .join(carry, "_y", "left")
            .select(F.col("d").alias(col), F.coalesce("_hit", "_carry").alias("trading_day")))
    return out.filter(F.col("trading_day").isNotNull())


def two_date_prices(bars: DataFrame, d0: Column, d1: Column) -> DataFrame:
    """J5 close at d0 and at d1 per code; codes missing either day drop out.

    On year-partitioned bars only the two years are read.
    """
    picked = bars.filter((F.col("date") == d0) | (F.col("date") == d1))
    if "year" in bars.columns:
        picked = picked.filter((F.col("year") == F.year(d0)) | (F.col("year") == F.year(d1)))
    g = picked.groupBy("code").agg(
        F.max(F.when(F.col("date") == d0, F.col("close"))).alias("old_price"),
        F.max(F.when(F.col("date") == d1, F.col("close"))).alias("new_price"))
    return g.filter(F.col("old_price").isNotNull() & F.col("new_price").isNotNull())


def pct_return(new: Column, old: Column) -> Column:
    """F13 (new / old - 1) · 100; old = 0 -> NULL."""
    return (F.try_divide(new.cast("double"), old.cast("double")) - F.lit(1.0)) * F.lit(100.0)


def _momentum(bars: DataFrame, items: DataFrame, start: str, end: str) -> DataFrame:
    d0, d1 = asof_trading_day(bars, start), asof_trading_day(bars, end)
    p = two_date_prices(bars, d0, d1)
    p = p.withColumn("returns", pct_return(F.col("new_price"), F.col("old_price")))
    return attach_names(p, items).select("code", "company", "old_price", "new_price", "returns")


def relative_momentum(bars: DataFrame, items: DataFrame, start: str, end: str, k: int) -> DataFrame:
    """M1 top-k codes by return between the trading days at ``start`` and ``end``.

    Ties are broken by code; ``rank`` numbers the (at most k) rows kept.
    """
    top = (_momentum(bars, items, start, end)
           .orderBy(F.desc("returns"), F.asc("code")).limit(k))
    # the frame below holds at most k rows (after the limit)
    rank = F.row_number().over(Window.orderBy(F.desc("returns"), F.asc("code")))
    return top.withColumn("rank", rank.cast("bigint"))


def absolute_momentum(bars: DataFrame, items: DataFrame, selected: DataFrame,
                      start: str, end: str) -> DataFrame:
    """M2 the same return for the codes of ``selected`` (J6), all of them, by return."""
    m = _momentum(bars, items, start, end).join(selected.select("code"), "code", "left_semi")
    return m.orderBy(F.desc("returns"), F.asc("code"))


def momentum_summary(momentum: DataFrame) -> DataFrame:
    """A6 mean return of a momentum selection."""
    return momentum.agg(F.count(F.lit(1)).alias("n_codes"), F.avg("returns").alias("mean_returns"))
