"""Scalar cleaning functions (F1–F10), all built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MEASURE_HEADERS, MEASURES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pad_code(code) -> Column:
    """F1/C13 zero-pad an integer code to 6 digits; longer codes stay whole;
    a code that is not an integer becomes NULL."""
    n = _c(code).try_cast("bigint")
    return F.when(n.isNotNull(), F.format_string("%06d", n))


def date_to_ymd(d) -> Column:
    """F2 date -> 'yyyyMMdd'."""
    return F.date_format(_c(d), "yyyyMMdd")


def ymd_to_date(text) -> Column:
    """F3 'yyyyMMdd' -> date (NULL when not a date)."""
    return F.try_to_date(_c(text), "yyyyMMdd")


def dotted_to_date(text) -> Column:
    """D6 'yyyy.MM.dd' quote-page dates -> date."""
    return F.try_to_date(F.trim(_c(text)), "yyyy.MM.dd")


def period_to_ym(header) -> Column:
    """F6 keep digits and slashes of a period header, '/' -> '-' ('2020/12(E)' -> '2020-12')."""
    return F.translate(F.regexp_replace(_c(header), r"[^0-9/]", ""), "/", "-")


def is_estimate(header) -> Column:
    """D12 the '(E)' marker that F6 drops."""
    return _c(header).contains("(E)")


def strip_nbsp(text) -> Column:
    """F7 remove no-break spaces."""
    return F.regexp_replace(_c(text), "\\u00a0", "")


def empty_to_zero(text) -> Column:
    """F8 an empty cell reads as '0'."""
    t = _c(text)
    return F.when(t == "", F.lit("0")).otherwise(t)


def clean_measure(text) -> Column:
    """F9 text containing 'N' (N/A) -> 0, otherwise commas removed; then a number."""
    t = _c(text).cast("string")
    cleaned = F.when(t.contains("N"), F.lit("0")).otherwise(F.regexp_replace(t, ",", ""))
    return cleaned.try_cast("double")


def after_last_equals(text) -> Column:
    """F10 the text after the last '=' (the page number of a pager link)."""
    return F.element_at(F.split(_c(text), "="), -1)


def parse_int_text(text) -> Column:
    """F11 '1,234' -> 1234 (BIGINT), '1,000.9' -> 1000 (truncated); blanks -> NULL."""
    plain = F.regexp_replace(F.trim(_c(text)), ",", "")
    whole = plain.try_cast("bigint")  # exact beyond 2^53
    return F.coalesce(whole, plain.try_cast("double").try_cast("bigint"))


def measure_name(header) -> Column:
    """Statement row header -> canonical measure name (NULL for unknown rows)."""
    pairs = []
    for h, m in zip(MEASURE_HEADERS, MEASURES):
        pairs += [F.lit(h), F.lit(m)]
    return F.element_at(F.create_map(*pairs), strip_nbsp(header))
