"""Listing, measure text, quote pages, statement pages, streaming upserts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import bars_frame, series_rows
from tickweave.functions import scalar as C
from tickweave.operators import upsert as U
from tickweave.schemas import MEASURES
from tickweave.sources import fixtures as X
from tickweave.sources import fundamentals as FD
from tickweave.sources import listing as L
from tickweave.sources import quotes as Q
from tickweave.streaming import bar_stream as ST


def test_listing_pads_and_never_truncates(spark):
    raw = spark.createDataFrame([(123, "Alpha Co", None), (1234567, "Long", "x")],
                                "`종목코드` bigint, `회사명` string, `업종` string")
    got = {r.code: r for r in L.read_listing(raw).collect()}
    assert set(got) == {"000123", "1234567"}
    assert got["000123"].name == "Alpha Co" and got["000123"].sector is None


def test_measure_cleaning(spark):
    df = spark.createDataFrame([("1,234",), ("N/A",), ("",), ("-5.5",), ("12,345,678",)], "t string")
    got = [r.v for r in df.select(C.clean_measure(C.empty_to_zero(F.col("t"))).alias("v")).collect()]
    assert got == [1234.0, 0.0, 0.0, -5.5, 12345678.0]


def test_period_and_header_cleaning(spark):
    df = spark.createDataFrame([("2020/12(E)", "\u00a0ROE(%)"), ("2019/03", "매출액")], "p string, m string")
    got = df.select(C.period_to_ym("p").alias("ym"), C.is_estimate("p").alias("e"),
                    C.measure_name("m").alias("n")).collect()
    assert [(r.ym, r.e, r.n) for r in got] == [("2020-12", True, "ROE"), ("2019-03", False, "SALES")]


def test_quote_pages_round_trip_with_cap(spark):
    closes = list(range(1000, 1027))
    bars = bars_frame(spark, series_rows("000123", closes, start="2021-01-04", step_days=1))
    pages = X.render_quote_pages(bars, rows_per_page=10)
    assert pages.count() == 3
    html = pages.filter("page = 1").first().html
    assert "pgRR" in html and "2021.01.30" in html
    got = Q.extract_quotes(pages, pages_to_fetch=2).orderBy("date").collect()
    assert len(got) == 20                                   # 2 of 3 pages
    assert got[-1].date == dt.date(2021, 1, 30) and got[-1].close == 1026 and got[-1].diff == 1
    assert got[0].close == 1007                             # rows 7..26 are on pages 1-2


def test_quote_page_parser_skips_blank_rows(spark):
    html = ('<table class="quotes"><tr><th>날짜</th><th>종가</th><th>전일비</th><th>시가</th>'
            '<th>고가</th><th>저가</th><th>거래량</th></tr><tr><td colspan="7"></td></tr>'
            '<tr><td>2021.02.01</td><td>82,000</td><td>1,100</td><td>81,000</td><td>83,000</td>'
            '<td>80,500</td><td>1,234,567</td></tr><tr><td>2021.01.29</td><td></td><td></td><td></td>'
            '<td></td><td></td><td></td></tr></table>'
            '<table><tr><td class="pgRR"><a href="/quotes?code=000123&amp;page=412">x</a>'
            '</td></tr></table>')
    pages = spark.createDataFrame([("000123", 1, html)], "code string, page int, html string")
    got = Q.extract_quotes(pages).collect()
    assert len(got) == 1 and got[0].close == 82000 and got[0].volume == 1234567
    raw = Q.parse_quote_pages(pages).first()
    assert raw.last_page.endswith("page=412")


def test_statement_pages_round_trip(spark):
    cells = spark.createDataFrame(
        [("A", "Y", "2019/12", 0, "매출액", "1,000"), ("A", "Y", "2020/12(E)", 1, "매출액", "N/A"),
         ("A", "Y", "2019/12", 0, "\u00a0ROE(%)", "12.5"), ("A", "Y", "2020/12(E)", 1, "\u00a0ROE(%)", "")],
        FD.CELL_SCHEMA)
    direct = {r.ym: r for r in FD.cells_to_rows(cells).collect()}
    parsed = {r.ym: r for r in FD.extract_fundamentals(X.render_statement_pages(cells)).collect()}
    assert direct["2019-12"].SALES == 1000.0 and direct["2019-12"].ROE == 12.5
    assert direct["2020-12"].SALES == 0.0 and direct["2020-12"].ROE == 0.0
    assert direct["2020-12"].is_estimate and not direct["2019-12"].is_estimate
    assert direct["2019-12"].DEBT is None
    for ym in direct:
        assert [direct[ym][m] for m in MEASURES] == [parsed[ym][m] for m in MEASURES]


def test_last_statement_of_a_period_wins(spark):
    """An actual and an estimate of one period: the column further right, whole; nothing is blended."""
    cells = spark.createDataFrame(
        [("A", "Y", "2020/12", 0, "매출액", "100"), ("A", "Y", "2020/12", 0, "영업이익", "5"), ("A", "Y", "2020/12", 0, "CAPEX", "1"),
         ("A", "Y", "2020/12(E)", 1, "매출액", "90"), ("A", "Y", "2020/12(E)", 1, "영업이익", "7")], FD.CELL_SCHEMA)
    row, = FD.cells_to_rows(cells).collect()
    assert (row.SALES, row.PROFIT, row.CAPEX, row.is_estimate) == (90.0, 7.0, None, True)


def test_statement_page_takes_the_right_table(spark):
    cells = spark.createDataFrame([("A", "Y", "2020/12", 0, "매출액", "100")], FD.CELL_SCHEMA)
    page = X.render_statement_pages(cells)
    assert page.first().html.index("77") < page.first().html.index("100")   # another table stands in front
    row, = FD.extract_fundamentals(page).collect()
    assert (row.ym, row.SALES, row.CAPEX) == ("2020-12", 100.0, None)


def test_quote_page_without_pager_gives_nothing(spark):
    bars = bars_frame(spark, series_rows("000123", [10, 11], start="2021-01-04", step_days=1))
    pages = X.render_quote_pages(bars)
    assert Q.extract_quotes(pages).count() == 2
    bare = pages.withColumn("html", F.regexp_replace("html", "pgRR", "other"))
    assert Q.extract_quotes(bare).count() == 0


def test_integer_text_is_truncated(spark):
    df = spark.createDataFrame([("1,000.0",), ("82,000",), ("-3.9",), ("",), ("x",), ("9,007,199,254,740,993",)], "t string")
    assert [r.v for r in df.select(C.parse_int_text("t").alias("v")).collect()] == [1000, 82000, -3, None, None, 9007199254740993]


def test_ingest_quotes_replaces_whole_bars_of_the_master(spark):
    stored = bars_frame(spark, series_rows("000123", [10, 11], start="2021-01-04", step_days=1)
                        + series_rows("000456", [20, 21], start="2021-01-04", step_days=1)).withColumn("year", F.year("date"))
    fresh = bars_frame(spark, series_rows("000123", [70, 72, 75], start="2021-01-04", step_days=1)
                       + series_rows("000456", [1, 2], start="2021-01-04", step_days=1))
    master = spark.createDataFrame([("000123",)], "code string")
    out = Q.ingest_quotes(stored, X.render_quote_pages(fresh), master)
    got = sorted((r.code, r.close, r["diff"]) for r in out.collect())
    assert got == [("000123", 70, 0), ("000123", 72, 2), ("000123", 75, 3), ("000456", 20, None), ("000456", 21, None)]


def _by_year(df):
    return df.withColumn("year", F.year("date"))


def _closes(df):
    return sorted((r.code, r.date.isoformat(), r.close) for r in df.collect())


def _stage(df, path):
    df.write.mode("append").parquet(path)


def test_stream_upsert_equals_batch_upsert(spark):
    cur = _by_year(bars_frame(spark, series_rows("A", [1, 2, 3], start="2020-01-06")))
    b1 = _by_year(bars_frame(spark, series_rows("A", [20, 30, 40], start="2020-01-13")).withColumn("_seq", F.lit(1)))
    b2 = _by_year(bars_frame(spark, series_rows("A", [99], start="2020-01-20")).withColumn("_seq", F.lit(2)))
    expect = _closes(U.upsert(cur, b1.unionByName(b2), ["code", "date"]))
    for files in (None, 1):
        assert _closes(X.replay_upserts(spark, cur, [b1, b2], max_files_per_trigger=files)) == expect
    assert [c for _, _, c in expect] == [1, 20, 99, 40]


def test_stream_runs_again_where_it_stopped(spark):
    """Nightly runs on one checkpoint: new files merge, an idle run changes nothing, untouched years are not written."""
    import glob
    from tickweave.session import local_path, scratch_path
    root = scratch_path(spark, "stream-again")
    stamp = lambda df: df.withColumn("reg_dt", U.stamp("2019-01-01 00:00:00")).withColumn("upd_dt", U.stamp("2019-01-01 00:00:00"))
    cur = stamp(_by_year(bars_frame(spark, series_rows("A", [1, 2], start="2019-12-23") + series_rows("A", [5], start="2018-01-01"))))
    cur.write.partitionBy("year").parquet(f"{root}/initial")

    def night(rows, ts):
        if rows:
            _stage(_by_year(bars_frame(spark, rows)).withColumn("_seq", F.lit(1)), f"{root}/in")
        schema = spark.read.parquet(f"{root}/in").schema
        return ST.stream_upsert_bars(spark, f"{root}/in", schema, f"{root}/initial", f"{root}/bars", f"{root}/ck", ts=ts)

    first = night(series_rows("A", [20, 3], start="2019-12-30"), "2020-02-01 00:00:00")
    want = [("A", "2018-01-01", 5), ("A", "2019-12-23", 1), ("A", "2019-12-30", 20), ("A", "2020-01-06", 3)]
    assert _closes(first) == want
    kept = {r.date.isoformat(): (str(r.reg_dt)[:4], str(r.upd_dt)[:4]) for r in first.collect()}
    assert kept == {"2018-01-01": ("2019", "2019"), "2019-12-23": ("2019", "2019"), "2019-12-30": ("2019", "2020"), "2020-01-06": ("2020", "2020")}
    assert _closes(night([], "2020-02-02 00:00:00")) == want
    last = night(series_rows("A", [33], start="2020-01-06"), "2020-02-03 00:00:00")
    assert _closes(last) == [*want[:3], ("A", "2020-01-06", 33)]
    written = sorted(p.split("/bars/")[1] for p in glob.glob(local_path(f"{root}/bars/_version=*/year=*")))
    assert [w.split("/")[1] for w in written] == ["year=2019", "year=2020", "year=2020"]


def _stream(spark, root, **how):
    schema = spark.read.parquet(f"{root}/in").schema
    return ST.stream_upsert_bars(spark, f"{root}/in", schema, f"{root}/initial", f"{root}/bars", f"{root}/ck", **how)


def test_half_written_version_is_not_read(spark):
    """A batch that died before its commit leaves files that nobody reads; its replay writes them anew."""
    from tickweave.session import scratch_path
    root = scratch_path(spark, "stream-crash")
    cur = _by_year(bars_frame(spark, series_rows("A", [1, 2], start="2020-01-06") + series_rows("B", [7], start="2020-01-06")))
    cur.write.partitionBy("year").parquet(f"{root}/initial")
    # one of the year's rows, no manifest
    cur.filter("code = 'A'").limit(1).write.partitionBy("year").parquet(f"{root}/bars/_version=0000000000")
    assert _closes(ST.table_now(spark, f"{root}/initial", f"{root}/bars")) == _closes(cur)
    _stage(_by_year(bars_frame(spark, series_rows("A", [10], start="2020-01-06"))).withColumn("_seq", F.lit(1)), f"{root}/in")
    want = [("A", "2020-01-06", 10), ("A", "2020-01-13", 2), ("B", "2020-01-06", 7)]
    assert _closes(_stream(spark, root)) == want
    # the stream's own record is lost after the commit: the batch comes again and changes nothing
    schema = spark.read.parquet(f"{root}/in").schema
    again = ST.stream_upsert_bars(spark, f"{root}/in", schema, f"{root}/initial", f"{root}/bars", f"{root}/other-ck")
    assert _closes(again) == want


def test_unreadable_versions_are_an_error(spark):
    import os
    from tickweave.session import local_path, scratch_path
    root = scratch_path(spark, "stream-broken")
    cur = _by_year(bars_frame(spark, series_rows("A", [1], start="2020-01-06")))
    cur.write.partitionBy("year").parquet(f"{root}/initial")
    os.makedirs(local_path(f"{root}/bars/_manifest"))
    with open(local_path(f"{root}/bars/_manifest/0000000000.json"), "w") as f:
        f.write("{")
    with pytest.raises(ValueError):
        ST.table_now(spark, f"{root}/initial", f"{root}/bars")


def test_vacuum_keeps_the_table_and_bounds_its_space(spark):
    import glob
    import os
    from tickweave.session import local_path, scratch_path
    from tickweave.sources.versions import Versions
    root = scratch_path(spark, "stream-vacuum")
    cur = _by_year(bars_frame(spark, series_rows("A", range(1, 90), start="2019-06-03") + series_rows("B", range(1, 90), start="2019-06-03")))
    cur.write.partitionBy("year").parquet(f"{root}/initial")
    for night in range(6):
        _stage(_by_year(bars_frame(spark, series_rows("A", [100 + night], start="2020-01-06"))).withColumn("_seq", F.lit(1)), f"{root}/in")
        out = _stream(spark, root, vacuum_keep=2)
    table = _closes(out)
    assert len(table) == 178 and ("A", "2020-01-06", 105) in table
    folders = glob.glob(local_path(f"{root}/bars/_version=*/year=*"))
    assert sorted(os.path.basename(os.path.dirname(f)) for f in folders) == ["_version=0000000004", "_version=0000000005"]
    versions = Versions(spark, f"{root}/bars")
    assert versions.batches() == [4, 5] and versions.manifest() == {"": {"year=2020": 5}}
    # a version above the newest commit may be at work, and stays
    cur.limit(1).write.partitionBy("year").parquet(f"{root}/bars/_version=0000000009")
    assert versions.vacuum() == [f"{root}/bars/_version=0000000004"] and versions.vacuum() == []
    assert _closes(ST.table_now(spark, f"{root}/initial", f"{root}/bars")) == table
    size = (lambda top: sum(os.path.getsize(f) for f in glob.glob(local_path(f"{root}/{top}/**/*.parquet"), recursive=True)))
    assert size("bars/_version=0000000005") <= size("initial")


def test_partition_values_of_every_kind(spark):
    from tickweave.session import scratch_path
    from tickweave.sources.versions import Versions
    versions = Versions(spark, scratch_path(spark, "versions"))
    rows = [("x", "a b", 1), ("x", None, 2), ("y", "c/d", 3), ("y", "a b", 4)]
    table = spark.createDataFrame(rows, "p string, q string, v int").select("v", "p", "q")
    assert versions.table(table, "t", ["p", "q"]).count() == 4
    new = table.filter("q is null or q = 'c/d'").withColumn("v", F.col("v") * 10)
    new.write.partitionBy("p", "q").parquet(versions.folder(3, "t"))
    assert versions.table(table, "t", ["p", "q"]).agg(F.sum("v")).first()[0] == 10
    versions.commit(3, {"t": versions.written(3, "t", depth=2)})
    assert sorted(r.v for r in versions.table(table, "t", ["p", "q"]).collect()) == [1, 4, 20, 30]
    with pytest.raises(RuntimeError):
        versions.commit(3, {"t": []})


def test_listing_and_bars_become_visible_together(spark, monkeypatch):
    from tickweave.session import scratch_path
    from tickweave.sources.versions import Versions
    stamp = (lambda df, upd: df.withColumn("reg_dt", U.stamp("2019-01-01 00:00:00")).withColumn("upd_dt", U.stamp(upd) if upd else F.lit(None).cast("timestamp")))
    listing = (lambda *names: spark.createDataFrame([(i, n) for i, n in names], "code int, company string"))
    items = stamp(L.listing_to_items(L.read_listing(listing((1, "old"), (2, "two"))), "20190101"), None)
    bars = stamp(_by_year(bars_frame(spark, series_rows("000001", [1, 2], start="2019-12-30") + series_rows("000002", [5], start="2018-01-01"))), "2019-01-01 00:00:00")
    staged = _by_year(bars_frame(spark, series_rows("000001", [20], start="2020-01-06") + series_rows("000003", [9], start="2020-01-06") + series_rows("000002", [6], start="2020-01-06")))
    versions = Versions(spark, scratch_path(spark, "chain"))
    run = (lambda: U.commit_listing_then_bars(versions, 7, items, listing((1, "new"), (3, "three")), bars, staged, "20210201", "2020-01-01", "2021-02-01 17:00:00"))
    with monkeypatch.context() as m:
        m.setattr(Versions, "commit", lambda *a: (_ for _ in ()).throw(OSError("the driver died")))
        with pytest.raises(OSError):
            run()
    assert _closes(versions.table(bars, "bars", ["year"])) == _closes(bars) and versions.table(items, "items").count() == 2
    for _ in range(2):
        master, out = run()
        assert {r.code: (r.name, r.upd_dt is not None) for r in master.collect()} == {"000001": ("new", True), "000002": ("two", False), "000003": ("three", False)}
        assert _closes(out) == [("000001", "2019-12-30", 1), ("000001", "2020-01-06", 20), ("000002", "2018-01-01", 5), ("000003", "2020-01-06", 9)]


def _executed(df):
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_statement_pivot_is_hash_aggregated(spark):
    cells = spark.createDataFrame([("A", "Y", "2020/12", 0, "매출액", "100")], FD.CELL_SCHEMA)
    plan = _executed(FD.cells_to_rows(cells))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan


def test_fundamentals_merge_touches_the_years_of_the_batch(spark):
    from tickweave.session import scratch_path
    path = scratch_path(spark, "fundamentals")
    rows = (lambda *r: FD.with_year(spark.createDataFrame([(c, ym, "Y", False, *v) for c, ym, *v in r], "code string, ym string, gb string, is_estimate boolean, SALES double, CAPEX double")))
    stored = FD.with_audit(rows(("A", "2018-12", 1.0, 2.0), ("A", "2019-12", 3.0, 4.0), ("B", "2019-12", 5.0, 6.0), ("B", "", 7.0, 8.0)), "2020-01-01 00:00:00")
    stored.write.partitionBy("year").parquet(path)
    batch = rows(("A", "2019-12", 30.0, None), ("C", "2020-12", 9.0, 9.0))
    table = spark.read.parquet(path)
    before = {f for f in table.inputFiles() if "year=2019" not in f}
    out = U.store_fundamentals(path, table, batch, "2021-02-01 17:00:00")
    got = {(r.code, r.ym): (r.SALES, r.CAPEX, str(r.reg_dt)[:4]) for r in out.collect()}
    assert got == {("A", "2018-12"): (1.0, 2.0, "2020"), ("A", "2019-12"): (30.0, None, "2021"), ("B", "2019-12"): (5.0, 6.0, "2020"),
                   ("B", ""): (7.0, 8.0, "2020"), ("C", "2020-12"): (9.0, 9.0, "2021")}
    assert before and before <= set(out.inputFiles())          # other years' files are the same files
    whole = U.merge_incremental(stored, batch, ["year"], U.merge_fundamentals, "2021-02-01 17:00:00")
    assert {(r.code, r.ym): (r.SALES, r.CAPEX, str(r.reg_dt)[:4]) for r in whole.collect()} == got


def test_stream_needs_a_checkpoint(spark):
    with pytest.raises(TypeError):
        ST.stream_upsert_bars(spark, "in", None, "initial", "root")


def test_ensure_table_creates_empty_then_reads(spark):
    from tickweave.schemas import COMPANY_INFO
    from tickweave.session import scratch_path
    path = scratch_path(spark, "k1")
    t = U.ensure_table(spark, path, COMPANY_INFO)
    assert t.count() == 0 and t.schema.names == COMPANY_INFO.names
    spark.createDataFrame([("000001", "A", dt.date(2021, 1, 1))], COMPANY_INFO).write.mode("append").parquet(path)
    assert U.ensure_table(spark, path, COMPANY_INFO).count() == 1


def test_vendor_bars_since_and_adjusted(spark):
    from tickweave.session import scratch_path
    path = scratch_path(spark, "vendor")
    rows = [("000123", dt.date(2020, 12, 30), 1.0, 3.0, 0.5, 2.5, 2.4, 100.0),
            ("000123", dt.date(2021, 1, 4), 2.0, 4.0, 1.5, 3.9, 3.8, 200.0)]
    spark.createDataFrame(rows, L.VENDOR_SCHEMA).write.parquet(path)
    got = L.read_vendor_bars(spark, path, "2021-01-01", adj=True).collect()
    assert len(got) == 1 and got[0].close == 3 and got[0].ymd == "20210104" and got[0].adj_close == 3.8


def test_stream_refreshes_touched_codes(spark):
    from tickweave.operators import indicators as I
    from tickweave.session import scratch_path
    root = scratch_path(spark, "stream-refresh")
    cur = bars_frame(spark, series_rows("A", [1, 2, 3], start="2020-01-06")
                     + series_rows("B", [5, 6, 7], start="2020-01-06"))
    _by_year(cur).write.partitionBy("year").parquet(f"{root}/initial")
    b1 = _by_year(bars_frame(spark, series_rows("A", [30], start="2020-01-20")).withColumn("_seq", F.lit(1)))
    _stage(b1, f"{root}/in")
    seen = []

    def hook(snapshot, codes, batch_id):
        fresh = ST.refresh_for_codes(snapshot, codes, lambda b: I.ewm(b, "close", 3, "e3"))
        seen.append(sorted((r.code, r.date.isoformat(), round(r.e3, 6)) for r in fresh.collect()))

    schema = spark.read.parquet(f"{root}/in").schema
    ST.stream_upsert_bars(spark, f"{root}/in", schema, f"{root}/initial", f"{root}/bars", f"{root}/ck", on_snapshot=hook)
    assert len(seen) == 1 and {c for c, _, _ in seen[0]} == {"A"}
    assert seen[0][-1][2] == pytest.approx(((30 + 0.5 * 2 + 0.25 * 1) / 1.75))
