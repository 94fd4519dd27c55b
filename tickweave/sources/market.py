"""Security master and price scans.

Argument rules of the price scan run on the driver (they are checks on a
few strings); the scan itself is a filter that Parquet pushes down.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_items(items: DataFrame) -> DataFrame:
    """S1 code -> name of every security."""
    return items.select("code", "name")


def read_company_info(company_info: DataFrame) -> DataFrame:
    """S2 code -> company of the simple master."""
    return company_info.select("code", "company")


def active_universe(items: DataFrame) -> DataFrame:
    """S6 codes and names with status 'Y'."""
    return items.filter(F.col("status") == "Y").select("code", "name")


def parse_date_arg(text: str, end: bool = False) -> str:
    """S3 argument rules: ``yyyyMMdd`` or ``yyyy-MM-dd`` -> ``yyyyMMdd``.

    Start years must lie in 1900–2200, end years in 1800–2200, months in
    1–12, days in 1–31 (an impossible day such as Feb 31 passes and is
    compared as text).  Violations raise ``ValueError``.
    """
    form = re.fullmatch(r"(\d{4})(\d{2})(\d{2})|(\d{4})-(\d{1,2})-(\d{1,2})", text, re.ASCII)
    if form is None:
        raise ValueError(f"date {text!r} is not yyyyMMdd or yyyy-MM-dd")
    year, month, day = (int(x) for x in form.groups() if x is not None)
    bound = "range end" if end else "range start"
    for name, value, low, high in (("year", year, 1800 if end else 1900, 2200), ("month", month, 1, 12), ("day", day, 1, 31)):
        if not low <= value <= high:
            raise ValueError(f"{bound} {text!r}: {name} {value} lies outside {low} to {high}")
    return f"{year:04d}{month:02d}{day:02d}"


def default_range(as_of: dt.date) -> tuple[str, str]:
    """Default scan range: the 365 days up to ``as_of`` (the run date)."""
    return (as_of - dt.timedelta(days=365)).strftime("%Y%m%d"), as_of.strftime("%Y%m%d")


def tokens_frame(spark: SparkSession, tokens: Iterable[str]) -> DataFrame:
    schema = T.StructType([T.StructField("token", T.StringType(), False)])
    return spark.createDataFrame([(t,) for t in tokens], schema)


def resolve_tokens(tokens: DataFrame, items: DataFrame) -> DataFrame:
    """J1 token -> code: a code matches itself first; otherwise a name maps to
    the first code carrying it (smallest code); unknown tokens get NULL."""
    by_code = items.select(F.col("code").alias("token"), F.col("code").alias("_by_code"))
    by_name = (items.groupBy(F.col("name").alias("token"))
                    .agg(F.min("code").alias("_by_name")))
    return (tokens.join(by_code, "token", "left")
                  .join(by_name, "token", "left")
                  .select("token", F.coalesce("_by_code", "_by_name").alias("code")))


def daily_price(bars: DataFrame, codes: DataFrame, start: str | None = None,
                end: str | None = None, as_of: dt.date | None = None,
                strict: bool = False, warmup_days: int = 0) -> DataFrame:
    """S3 bars of the given codes in an inclusive ``ymd`` range.

    ``codes`` is a DataFrame with a ``code`` column (e.g. ``resolve_tokens``
    output); unknown codes simply return no rows (``strict`` raises on the
    driver instead, which needs one small action).  The range compares the
    ``yyyyMMdd`` text, so impossible days still bound the scan; a ``year``
    predicate is added for partition pruning of year-partitioned bars.

    Indicators computed on the result start cold at ``start`` (C10).  With
    ``warmup_days`` the scan also reads that many calendar days before
    ``start``; those rows carry ``warmup = true`` and ``trim_warmup`` drops them
    after the windows are computed.
    """
    if start is None or end is None:
        d0, d1 = default_range(as_of or dt.date.today())
        start, end = start or d0, end or d1
    start, end = parse_date_arg(start), parse_date_arg(end, end=True)
    first = start
    if warmup_days:
        first = (dt.date(int(start[:4]), int(start[4:6]), 1)
                 + dt.timedelta(days=min(int(start[6:]), 28) - 1 - warmup_days)).strftime("%Y%m%d")
    wanted = codes.select("code").filter(F.col("code").isNotNull()).distinct()
    if strict and wanted.isEmpty():
        raise ValueError("no code resolved")
    # on a year-partitioned table the predicate on the partition column prunes folders
    year = F.col("year") if "year" in bars.columns else F.year("date")
    out = (bars.filter((F.col("ymd") >= first) & (F.col("ymd") <= end)
                       & (year >= int(first[:4])) & (year <= int(end[:4])))
               .join(wanted, "code", "left_semi"))
    return out.withColumn("warmup", F.col("ymd") < start) if warmup_days else out


def trim_warmup(df: DataFrame) -> DataFrame:
    """Drop the warm-up rows of a ``daily_price(..., warmup_days=...)`` scan."""
    return df.filter(~F.col("warmup")).drop("warmup") if "warmup" in df.columns else df


def daily_price_raw(bars: DataFrame, code: str, start: str, end: str) -> DataFrame:
    """S4 one code, text bounds as given, no checks or defaults."""
    return bars.filter((F.col("code") == code) & (F.col("ymd") >= start) & (F.col("ymd") <= end))


def price_history(bars: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """S5/T1 whole history, ordered by date within each code."""
    src = bars if codes is None else bars.join(codes.select("code").distinct(), "code", "left_semi")
    return src.orderBy("code", "date")


def attach_names(df: DataFrame, items: DataFrame, col: str = "company") -> DataFrame:
    """J2 company name next to each code (inner: codes outside the master drop)."""
    return df.join(items.select("code", F.col("name").alias(col)), "code", "inner")
