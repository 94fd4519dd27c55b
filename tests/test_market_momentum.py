"""Scans, token resolution, as-of dates and momentum edge cases."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import bars_frame, series_rows
from tickweave.operators import momentum as M
from tickweave.sources import market as K


@pytest.fixture(scope="module")
def items(spark):
    rows = [("000001", "ALPHA", "Y"), ("000002", "BETA", "Y"), ("000003", "ALPHA", "N"),
            ("000004", "000002", "Y")]
    return spark.createDataFrame(rows, "code string, name string, status string")


def test_parse_date_arg_rules():
    assert K.parse_date_arg("2019-1-2") == "20190102"
    assert K.parse_date_arg("20190231") == "20190231"        # impossible day passes (text compare)
    with pytest.raises(ValueError):
        K.parse_date_arg("20191301")
    with pytest.raises(ValueError):
        K.parse_date_arg("18990101")
    assert K.parse_date_arg("18990101", end=True) == "18990101"
    with pytest.raises(ValueError):
        K.parse_date_arg("2019-01-32")


def test_resolve_tokens_code_first_then_first_name(spark, items):
    toks = K.tokens_frame(spark, ["000002", "ALPHA", "GAMMA", "BETA"])
    got = dict(K.resolve_tokens(toks, items).collect())
    assert got["000002"] == "000002"      # a code wins over another row's name
    assert got["ALPHA"] == "000001"       # first code carrying the name
    assert got["GAMMA"] is None
    assert got["BETA"] == "000002"


def test_daily_price_range_and_unknown_token(spark, items):
    rows = series_rows("000001", [10, 11, 12, 13], start="2019-02-25", step_days=1)
    bars = bars_frame(spark, rows)
    codes = K.resolve_tokens(K.tokens_frame(spark, ["ALPHA"]), items)
    got = K.daily_price(bars, codes, "20190226", "20190231").select("ymd").collect()
    assert [r.ymd for r in got] == ["20190226", "20190227", "20190228"]
    none = K.resolve_tokens(K.tokens_frame(spark, ["NOPE"]), items)
    assert K.daily_price(bars, none, "20190101", "20191231").count() == 0
    with pytest.raises(ValueError):
        K.daily_price(bars, none, "20190101", "20191231", strict=True)


def test_default_range_is_365_days():
    assert K.default_range(dt.date(2021, 3, 1)) == ("20200301", "20210301")


def test_active_universe(items):
    assert sorted(r.code for r in K.active_universe(items).collect()) == ["000001", "000002", "000004"]


def _bars3(spark):
    rows = (series_rows("000001", [100, 110, 120], start="2020-01-06")
            + series_rows("000002", [100, 90, 200], start="2020-01-06")
            + series_rows("000004", [50, 55], start="2020-01-13"))
    return bars_frame(spark, rows)


def test_asof_before_first_day_gives_nothing(spark):
    b = _bars3(spark)
    d = b.select(M.asof_trading_day(b, "2019-12-31").alias("d")).first().d
    assert d is None
    req = spark.createDataFrame([(dt.date(2019, 12, 31),), (dt.date(2020, 1, 15),)], "requested date")
    got = M.asof_days(req, b).collect()
    assert [(r.requested, r.trading_day) for r in got] == [(dt.date(2020, 1, 15), dt.date(2020, 1, 13))]


def test_relative_momentum_fewer_codes_than_k(spark, items):
    b = _bars3(spark)
    got = M.relative_momentum(b, items, "2020-01-06", "2020-01-20", k=10).orderBy("rank").collect()
    assert [r.code for r in got] == ["000002", "000001"]   # 000004 has no bar on 2020-01-06
    assert got[0].returns == pytest.approx(100.0) and got[0].rank == 1
    assert got[1].company == "ALPHA"


def test_absolute_momentum_keeps_selected_codes_only(spark, items):
    b = _bars3(spark)
    sel = spark.createDataFrame([("000001",)], "code string")
    got = M.absolute_momentum(b, items, sel, "2020-01-13", "2020-01-20").collect()
    assert [r.code for r in got] == ["000001"]
    summ = M.momentum_summary(M.absolute_momentum(b, items, sel, "2020-01-13", "2020-01-20")).first()
    assert summ.n_codes == 1 and summ.mean_returns == pytest.approx((120 / 110 - 1) * 100)


def test_momentum_ties_broken_by_code(spark):
    rows = (series_rows("B", [100, 110], start="2020-01-06") + series_rows("A", [10, 11], start="2020-01-06"))
    b = bars_frame(spark, rows)
    items = spark.createDataFrame([("A", "a"), ("B", "b")], "code string, name string")
    got = M.relative_momentum(b, items, "2020-01-06", "2020-01-13", 1).collect()
    assert [r.code for r in got] == ["A"]
    assert F is not None


def test_date_text_round_trip_and_raw_scan(spark, items):
    from tickweave.functions import scalar as C
    df = spark.createDataFrame([("20210131",), ("20210231",), ("junk",)], "t string")
    got = df.select(C.ymd_to_date("t").alias("d")).collect()
    assert [r.d for r in got] == [dt.date(2021, 1, 31), None, None]
    back = spark.createDataFrame([(dt.date(2021, 1, 31),)], "d date").select(C.date_to_ymd("d").alias("t")).first()
    assert back.t == "20210131"
    bars = bars_frame(spark, series_rows("000001", [1, 2, 3], start="2021-01-30", step_days=1))
    raw = K.daily_price_raw(bars, "000001", "20210131", "20210201").select("ymd").collect()
    assert [r.ymd for r in raw] == ["20210131", "20210201"]
    assert K.read_items(items).columns == ["code", "name"]
    info = spark.createDataFrame([("000001", "A", dt.date(2021, 1, 1))], "code string, company string, last_update date")
    assert K.read_company_info(info).columns == ["code", "company"]


def test_warmup_reads_earlier_rows_then_trims(spark, items):
    from tickweave.operators import indicators as I
    rows = series_rows("000001", list(range(100, 130)), start="2020-01-06", step_days=7)
    bars = bars_frame(spark, rows)
    codes = spark.createDataFrame([("000001",)], "code string")
    cold = I.sma(K.daily_price(bars, codes, "20200406", "20200727"), "close", 5)
    warm = K.trim_warmup(I.sma(K.daily_price(bars, codes, "20200406", "20200727", warmup_days=60), "close", 5))
    c = [r.ma5 for r in cold.orderBy("date").collect()]
    w = [r.ma5 for r in warm.orderBy("date").collect()]
    assert len(c) == len(w) == 17
    assert c[:4] == [None] * 4 and c[4] is not None            # cold start at the range start
    assert all(x is not None for x in w)                       # warmed up from earlier rows
    assert w[4:] == c[4:]


def test_asof_days_carries_across_years(spark):
    rows = (series_rows("000001", [1, 2], start="2019-12-23", step_days=7)       # 2019-12-23, 2019-12-30
            + series_rows("000001", [3], start="2020-01-13", step_days=7)        # 2020-01-13
            + series_rows("000001", [4], start="2022-03-07", step_days=7))       # nothing in 2021
    b = bars_frame(spark, rows)
    req = spark.createDataFrame([(dt.date(2020, 1, 2),), (dt.date(2020, 1, 13),), (dt.date(2021, 6, 1),),
                                 (dt.date(2022, 1, 3),), (dt.date(2019, 1, 1),)], "requested date")
    got = {r.requested: r.trading_day for r in M.asof_days(req, b).collect()}
    assert got == {dt.date(2020, 1, 2): dt.date(2019, 12, 30),     # carried from the previous year
                   dt.date(2020, 1, 13): dt.date(2020, 1, 13),     # same day counts
                   dt.date(2021, 6, 1): dt.date(2020, 1, 13),      # a year without trading days
                   dt.date(2022, 1, 3): dt.date(2020, 1, 13)}      # before the year's first bar


def test_ordered_results_are_sorted(spark):
    """The rows themselves come in order, across all partitions."""
    import __spark_entry__ as E
    from conftest import SF001
    history = [(r.code, r.date) for r in E.queries()["price_history"](spark, SF001).collect()]
    assert history == sorted(history) and len(history) > 1000
    ranked = [(-r.returns, r.code) for r in E.queries()["absolute_momentum"](spark, SF001).collect()]
    assert ranked == sorted(ranked)


def test_strict_date_forms():
    import pytest
    from tickweave.sources.market import parse_date_arg
    assert parse_date_arg("20190231") == "20190231" and parse_date_arg("2019-2-5") == "20190205"
    for bad in ("abc20190101", "20-190-101", "2019/01/01", "201901", "20191301", "20190132", "18000101", ""):
        with pytest.raises(ValueError):
            parse_date_arg(bad)
    assert parse_date_arg("18000101", end=True) == "18000101"


def test_momentum_scans_prune_years(spark):
    from conftest import SF01
    from tickweave.operators import momentum as M
    from tickweave.sources import fixtures as X
    bars = X.stored_bars(spark, SF01, "day")
    out = M.two_date_prices(bars, M.asof_trading_day(bars, "1996-01-03"), M.asof_trading_day(bars, "1998-12-31"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    import re
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert filters and all("year" in f for f in filters)
    assert 0 < out.count() < 25


def test_asof_reads_one_year(spark):
    """The requested year alone, or the newest one before it where the year starts later; the scan after it reads two years' files."""
    from tickweave.operators import momentum as M
    from tickweave.session import scratch_path
    path = scratch_path(spark, "asof")
    days = [("A", dt.date(y, m, 3), 10 * y + m) for y in (2015, 2016, 2019) for m in (5, 8)]
    spark.createDataFrame(days, "code string, date date, close long").withColumn("year", F.year("date")).write.partitionBy("year").parquet(path)
    bars = spark.read.parquet(path)
    asof = (lambda day: bars.select(M.asof_trading_day(bars, day).alias("d")).first().d)
    assert asof("2016-06-01") == dt.date(2016, 5, 3) and asof("2016-12-31") == dt.date(2016, 8, 3)
    assert asof("2019-01-01") == dt.date(2016, 8, 3) and asof("2018-07-01") == dt.date(2016, 8, 3)
    assert asof("2015-01-01") is None and asof("2030-01-01") == dt.date(2019, 8, 3)
    out = M.two_date_prices(bars, M.asof_trading_day(bars, "2016-06-01"), M.asof_trading_day(bars, "2019-12-31"))
    assert [tuple(r) for r in out.collect()] == [("A", 20165, 20198)]
    filters = list(set(re.findall(r"PartitionFilters: \[([^\]]*)\]", out._jdf.queryExecution().executedPlan().toString())))
    assert len(filters) == 1 and "2016" in filters[0] and "2019" in filters[0] and "Subquery" not in filters[0]


def test_whole_ingest_chain(spark):
    """K7: the listing refreshes the master, then bars arrive for its codes alone."""
    from conftest import bars_frame, series_rows
    from pyspark.sql import functions as F
    from tickweave.operators import upsert as U
    from tickweave.sources import listing as L
    stamp = lambda df: df.withColumn("reg_dt", U.stamp("2020-01-01 00:00:00")).withColumn("upd_dt", F.lit(None).cast("timestamp"))
    raw = spark.createDataFrame([(1, "New Name"), (2, "Second")], "code int, company string")
    old = stamp(L.listing_to_items(L.read_listing(raw.limit(1).withColumn("company", F.lit("Old Name"))), "20200101"))
    current = stamp(bars_frame(spark, series_rows("000001", [10], start="2021-01-04")))
    staged = bars_frame(spark, series_rows("000001", [11], start="2021-01-04") + series_rows("000002", [7, 8], start="2021-01-04") + series_rows("000009", [1], start="2021-01-04"))
    items, bars = U.ingest_listing_then_bars(old, raw, current, staged, "20210201", "2021-01-01", "2021-02-01 17:00:00")
    assert {r.code: r.name for r in items.collect()} == {"000001": "New Name", "000002": "Second"}
    assert sorted((r.code, r.close, r.upd_dt.year) for r in bars.collect()) == [("000001", 11, 2021), ("000002", 7, 2021), ("000002", 8, 2021)]

