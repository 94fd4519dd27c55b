"""Driver contract and plan shape."""

import re

import __spark_entry__ as E
from conftest import SF01


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["code", "date", "close", "center", "stddev", "upper", "lower", "pb"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    missing = set(E.queries()) - set(E.oracle_sql()) - set(E.LLM_QUERIES)
    assert not missing, f"queries without oracle: {missing}"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = E.queries()["price_scan"](spark, SF01)
    plan = _plan(df)
    assert "PushedFilters" in plan
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("l_comment" not in s for s in scans)


def test_indicator_stack_single_window_exchange(spark):
    """The Bollinger/MFI stack adds its windows without extra shuffles: one exchange on code."""
    from tickweave.operators import signals as G
    from tickweave.sources import fixtures as X
    plan = _plan(G.trend_following(X.stored_bars(spark, SF01)))
    assert len(re.findall(r"Exchange hashpartitioning\(code#\d+, \d+\)", plan)) == 1, plan
