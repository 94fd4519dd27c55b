"""Bucketed stored bars: merges that leave the stored side where it is, replaced through a journal."""

import pytest
from pyspark.sql import functions as F

from conftest import bars_frame, series_rows
from tickweave.operators import upsert as U
from tickweave.session import scratch_path
from tickweave.sources.bucketed import JOURNAL, BucketedTable

TS = "2021-02-01 17:00:00"
BUCKETS = 3


def _year(df):
    return df.withColumn("year", F.year("date"))


def _rows(df):
    return sorted((r.code, str(r.date), r.close) for r in df.collect())


def _batch(spark):
    """Restated and new bars of two years, one key twice."""
    one = _year(bars_frame(spark, series_rows("A", [51, 52, 53, 54], start="2019-12-23") + series_rows("Z", [9], start="2020-03-02")))
    again = _year(bars_frame(spark, series_rows("A", [99], start="2019-12-30")))
    return one.withColumn("_seq", F.lit(1)).unionByName(again.withColumn("_seq", F.lit(2)))


@pytest.fixture
def stored(spark):
    bars = _year(bars_frame(spark, series_rows("A", list(range(1, 120)), start="2018-06-04") + series_rows("B", list(range(60)), start="2018-06-04")))
    bars = bars.withColumn("reg_dt", U.stamp("2020-01-01 00:00:00")).withColumn("upd_dt", U.stamp("2020-01-01 00:00:00"))
    path = scratch_path(spark, "bucketed")
    table = BucketedTable(spark, "t_" + path.rsplit("/", 1)[1], path, bars.schema, buckets=BUCKETS)
    table.load(bars)
    return bars, table


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("partitions", ["2", "50"])
def test_stored_side_has_no_exchange(spark, stored, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for merge_fn, args in ((U.merge_bars, (TS,)), (U.replace_bars, ())):
            plan = _plan(stored[1].merged(_batch(spark).where("_seq = 1").drop("_seq"), merge_fn, *args))
            assert plan.count("Exchange ") == 1 and f"hashpartitioning(code" in plan and f"{BUCKETS}), REPARTITION_BY_NUM" in plan
            assert "Bucketed: true" in plan and f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in plan
            plan = _plan(stored[1].merged(_batch(spark), merge_fn, *args))      # with arrival numbers: the batch is combined first
            side = plan[plan.index("SortMergeJoin"):plan.index("t_")]
            assert plan.count("Exchange ") == 2 and "Exchange" not in side
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_merge_equals_the_shuffled_merge(spark, stored):
    bars, table = stored
    batch = _batch(spark)
    want = U.merge_incremental(bars, batch, ["year"], U.merge_bars, TS)
    cols = bars.columns
    assert table.after(batch, U.merge_bars, TS).select(cols).exceptAll(want.select(cols)).count() == 0
    assert _rows(table.table()) == _rows(bars)                                  # nothing is written by ``after``
    old = {f for f in table.table().inputFiles() if "year=2018" in f}
    for _ in range(2):                                                          # a batch that comes again changes nothing
        out = table.apply(batch, U.merge_bars, TS).select(cols)
        keys = ["code", "date", "close", "year", "reg_dt"]
        assert out.count() == want.count() and out.select(keys).exceptAll(want.select(keys)).count() == 0
    files = table.table().inputFiles()
    assert old and old <= set(files)                                            # other years' files are the same files
    assert all(sum(f"year={y}/" in f for f in files) <= BUCKETS for y in (2018, 2019, 2020))


def test_whole_rows_replace(spark, stored):
    bars, table = stored
    batch = _batch(spark).withColumn("reg_dt", U.stamp(TS)).withColumn("upd_dt", F.lit(None).cast("timestamp"))
    want = U.upsert(bars, batch, ["code", "date"])
    out = table.apply(batch, U.replace_bars).select(bars.columns)
    assert out.count() == want.count() and out.exceptAll(want).count() == 0


def test_empty_batch_and_empty_table(spark, stored):
    bars, table = stored
    assert _rows(table.apply(_batch(spark).limit(0), U.merge_bars, TS)) == _rows(bars)
    path = scratch_path(spark, "bucketed")
    fresh = BucketedTable(spark, "t_" + path.rsplit("/", 1)[1], path, bars.schema, buckets=BUCKETS)
    assert fresh.table().count() == 0
    assert _rows(fresh.apply(_batch(spark), U.merge_bars, TS)) == [("A", "2019-12-23", 51), ("A", "2019-12-30", 99), ("A", "2020-01-06", 53),
                                                                  ("A", "2020-01-13", 54), ("Z", "2020-03-02", 9)]


@pytest.mark.parametrize("crash", ["while writing", "before the moves", "between the moves"])
def test_journal_is_finished_or_discarded(spark, stored, crash, monkeypatch):
    bars, table = stored
    batch = _batch(spark)
    want = _rows(table.after(batch, U.merge_bars, TS))
    with monkeypatch.context() as m:
        m.setattr(BucketedTable, "_finish", lambda self: None)
        table.apply(batch, U.merge_bars, TS)
    fs, at, journal = table._fs, table._at, f"{table.path}/{JOURNAL}"
    assert table._partitions(journal) == ["year=2019", "year=2020"] and fs.exists(at(f"{journal}/_SUCCESS"))
    if crash == "while writing":
        fs.delete(at(f"{journal}/_SUCCESS"), False)
    elif crash == "between the moves":
        fs.delete(at(f"{table.path}/year=2019"), True)
        fs.rename(at(f"{journal}/year=2019"), at(f"{table.path}/year=2019"))
        fs.delete(at(f"{table.path}/year=2020"), True)
    again = BucketedTable(spark, table.name + "_again", table.path, bars.schema, buckets=BUCKETS)
    assert _rows(again.table()) == (_rows(bars) if crash == "while writing" else want)
    assert not fs.exists(at(journal))
    assert _rows(again.apply(batch, U.merge_bars, TS)) == want
