"""Portfolio statistics and set-based upserts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import bars_frame, series_rows
from tickweave.operators import portfolio as P
from tickweave.operators import upsert as U


@pytest.fixture(scope="module")
def three(spark):
    rows = (series_rows("A", [100, 102, 101, 105, 107, 106, 110], start="2020-01-06")
            + series_rows("B", [50, 49, 52, 53, 51, 55, 56], start="2020-01-06")
            # C starts late and misses one of A's dates; it has one date A lacks
            + [r for i, r in enumerate(series_rows("C", [20, 21, 22, 21, 23, 24, 25], start="2020-01-06"))
               if i not in (0, 3)]
            + [("C", "2020-01-08", 30, 32, 28, 30, 5)])
    return bars_frame(spark, rows)


def _pandas_returns(pdf):
    first = sorted(pdf.code.unique())[0]
    wide = pd.DataFrame(index=pdf[pdf.code == first].sort_values("date").date)
    for c in sorted(pdf.code.unique()):
        s = pdf[pdf.code == c].set_index("date")["close"].astype(float)
        wide[c] = s.reindex(wide.index)
    return wide.ffill().pipe(lambda w: w / w.shift(1) - 1)


def test_returns_mean_and_cov_match_pandas(spark, three):
    uni = three.select("code").distinct()
    rets = P.aligned_returns(three, uni)
    exp = _pandas_returns(three.toPandas())
    got = rets.toPandas().pivot(index="date", columns="code", values="ret").reindex(exp.index)
    np.testing.assert_allclose(got[exp.columns].to_numpy(dtype=float), exp.to_numpy(), equal_nan=True)
    ann = dict(P.annual_returns(rets).collect())
    for c in exp.columns:
        assert ann[c] == pytest.approx(exp[c].mean() * 252)
    cov = {(r.code_i, r.code_j): r.cov for r in P.covariance(rets).collect()}
    ec = exp.cov() * 252
    for i in exp.columns:
        for j in exp.columns:
            assert cov[(i, j)] == pytest.approx(ec.loc[i, j], rel=1e-9)
            assert cov[(i, j)] == pytest.approx(cov[(j, i)])


def _vectors(weights, universe):
    """{portfolio: {code: weight}}"""
    out = {}
    for r in P.long_weights(weights, universe).collect():
        out.setdefault(r.portfolio_id, {})[r.code] = r.weight
    return out


def test_weights_sum_to_one_and_are_stable(spark, three):
    uni = three.select("code").distinct()
    w1, w2 = (_vectors(P.candidate_weights(spark, u, 50), u) for u in (uni, uni.repartition(3)))
    assert w1 == w2 and len(w1) == 50
    assert all(set(w) == set("ABC") and abs(sum(w.values()) - 1) < 1e-12 for w in w1.values())


def _check_scores(got, vectors, ann, cov, codes):
    mu, cm = dict(ann.collect()), {(r.code_i, r.code_j): r.cov for r in cov.collect()}
    mu, sig = np.array([mu[c] for c in codes]), np.array([[cm[(i, j)] for j in codes] for i in codes])
    for r in got:
        w = np.array([vectors[r.portfolio_id][c] for c in codes])
        assert r.returns == pytest.approx(w @ mu)
        assert r.risk == pytest.approx(np.sqrt(w @ sig @ w))
        assert r.sharpe == pytest.approx(r.returns / r.risk)


def test_scores_and_best(spark, three):
    uni = three.select("code").distinct()
    rets = P.aligned_returns(three, uni)
    ann, cov = P.annual_returns(rets), P.covariance(rets)
    weights = P.candidate_weights(spark, uni, 200)
    scores = P.portfolio_scores(weights, ann, cov, uni)
    rows = scores.collect()
    assert len(rows) == 200
    _check_scores(rows, _vectors(weights, uni), ann, cov, "ABC")
    best = P.portfolio_best(scores).toPandas()
    assert best[best.kind == "max_sharpe"].sharpe.iloc[0] == pytest.approx(max(r.sharpe for r in rows))
    assert best[best.kind == "min_risk"].risk.iloc[0] == pytest.approx(min(r.risk for r in rows))


def test_scores_of_a_part_of_the_covered_codes(spark, three):
    """Statistics over more codes than the universe, and in any order, are matched by code."""
    rets = P.aligned_returns(three, three.select("code").distinct())
    ann, cov = P.annual_returns(rets), P.covariance(rets)
    uni = spark.createDataFrame([("C",), ("A",)], "code string")
    weights = P.candidate_weights(spark, uni, 20)
    _check_scores(P.portfolio_scores(weights, ann, cov, uni).collect(), _vectors(weights, uni), ann, cov, "AC")


def test_codes_without_statistics_give_no_score(spark, three):
    rets = P.aligned_returns(three, three.select("code").distinct())
    uni = spark.createDataFrame([("A",), ("new",)], "code string")
    got = P.portfolio_scores(P.candidate_weights(spark, uni, 5), P.annual_returns(rets), P.covariance(rets), uni).collect()
    assert len(got) == 5 and all(r.returns is None and r.risk is None and r.sharpe is None for r in got)


def test_scores_of_3000_codes_in_blocks(spark):
    """A universe of 3,000: every row holds one block, and blocks and chunks add up to w·μ and wᵀΣw."""
    rng = np.random.default_rng(8)
    n = 3000
    codes = [f"c{i:04d}" for i in range(n)]
    factor, own, mu = rng.normal(0, 1, n), rng.uniform(0.5, 2, n), rng.normal(0.05, 0.1, n)
    uni = spark.createDataFrame(pd.DataFrame({"code": codes}))
    table = spark.createDataFrame(pd.DataFrame({"code": codes, "f": factor, "own": own, "annual_ret": mu})).repartition(4)
    i, j = (table.select(F.col("code").alias(f"code_{s}"), F.col("f").alias(f"f{s}"), F.col("own").alias(f"o{s}")) for s in "ij")
    cov = i.crossJoin(j).select("code_i", "code_j", (F.col("fi") * F.col("fj") + F.when(F.col("code_i") == F.col("code_j"), F.col("oi")).otherwise(0.0)).alias("cov"))
    weights = P.candidate_weights(spark, uni, 40)
    assert weights.agg(F.max(F.size("weights"))).first()[0] < 2 * P.BLOCK
    vectors = _vectors(weights, uni)
    got = P.portfolio_scores(weights, table.select("code", "annual_ret"), cov, uni).collect()
    assert len(got) == 40
    for r in got:
        w = np.array([vectors[r.portfolio_id][c] for c in codes])
        assert r.returns == pytest.approx(w @ mu, rel=1e-9)
        assert r.risk == pytest.approx(np.sqrt((w @ factor) ** 2 + (w * w) @ own), rel=1e-9)


def test_covariance_over_several_blocks_and_large_means(spark):
    rng = np.random.default_rng(2)
    n, days = 2 * P.BLOCK + 40, 12
    x = 1e6 + rng.normal(0, 1e-3, (days, n))
    x[rng.random((days, n)) < 0.1] = np.nan
    codes = [f"c{i:04d}" for i in range(n)]
    rows = [(codes[i], d, float(x[d, i])) for d in range(days) for i in range(n) if not np.isnan(x[d, i])]
    got = P.covariance(spark.createDataFrame(rows, "code string, k long, ret double")).toPandas()
    want = (pd.DataFrame(x - 1e6, columns=codes).cov() * 252).to_numpy()
    found = got.pivot(index="code_i", columns="code_j", values="cov").loc[codes, codes].to_numpy(dtype=float)
    np.testing.assert_allclose(found, want, rtol=1e-6, atol=1e-9)


def test_covariance_of_parts_with_other_codes(spark, monkeypatch):
    """Parts of the dates hold different codes; the tree of parts has several levels."""
    monkeypatch.setattr(P, "BLOCK", 3)
    monkeypatch.setattr(P, "PART_DATES", 2)
    rng = np.random.default_rng(3)
    days, codes = 80, list("abcdefgh")
    x = pd.DataFrame(rng.normal(0, 1, (days, len(codes))), columns=codes)
    for i, c in enumerate(codes):
        x.loc[: 9 * i, c] = np.nan                     # later codes start later
    x.loc[40:, "a"] = np.nan
    rows = [(c, d, float(x.loc[d, c])) for d in range(days) for c in codes if not np.isnan(x.loc[d, c])]
    got = P.covariance(spark.createDataFrame(rows, "code string, k long, ret double")).toPandas()
    found = got.pivot(index="code_i", columns="code_j", values="cov").reindex(index=codes, columns=codes).to_numpy(dtype=float)
    np.testing.assert_allclose(found, (x.cov() * 252).to_numpy(), rtol=1e-9, atol=1e-12)


def _cur_batch(spark):
    cur = spark.createDataFrame([("A", 1, 10.0), ("B", 1, 20.0)], "code string, k int, v double")
    batch = spark.createDataFrame([("B", 1, 21.0, 1), ("B", 1, 22.0, 2), ("C", 1, 30.0, 1)],
                                  "code string, k int, v double, _seq int")
    return cur, batch


def test_upsert_last_write_wins_and_idempotent(spark):
    cur, batch = _cur_batch(spark)
    once = U.upsert(cur, batch, ["code", "k"])
    assert sorted(map(tuple, once.collect())) == [("A", 1, 10.0), ("B", 1, 22.0), ("C", 1, 30.0)]
    twice = U.upsert(once, batch, ["code", "k"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_merge_audit_columns(spark):
    cur = spark.createDataFrame([("A", 1, 10.0), ("B", 1, 20.0)], "code string, k int, v double") \
        .withColumn("reg_dt", U.stamp("2020-01-01 00:00:00")).withColumn("upd_dt", F.lit(None).cast("timestamp"))
    _, batch = _cur_batch(spark)
    m = U.merge(cur, batch, ["code", "k"], on_match={"upd_dt": U.stamp("2021-02-01 17:00:00")},
                on_insert={"reg_dt": U.stamp("2021-02-01 17:00:00")}, keep_on_match=["reg_dt"])
    got = {r.code: r for r in m.collect()}
    assert got["A"].v == 10.0 and got["A"].upd_dt is None                  # untouched
    assert got["B"].v == 22.0 and str(got["B"].reg_dt).startswith("2020-01-01")
    assert str(got["B"].upd_dt).startswith("2021-02-01")                   # matched
    assert str(got["C"].reg_dt).startswith("2021-02-01") and got["C"].upd_dt is None   # inserted
    again = U.merge(m, batch, ["code", "k"], on_match={"upd_dt": U.stamp("2021-02-01 17:00:00")},
                    on_insert={"reg_dt": U.stamp("2021-02-01 17:00:00")}, keep_on_match=["reg_dt"])
    # a re-run matches what the first run inserted: values and reg_dt stay, upd_dt is stamped
    first = {r.code: r for r in m.collect()}
    for r in again.collect():
        assert (r.v, r.reg_dt) == (first[r.code].v, first[r.code].reg_dt)
    assert {r.code: r.upd_dt is not None for r in again.collect()} == {"A": False, "B": True, "C": True}


def test_needs_refresh(spark):
    empty = spark.createDataFrame([], "code string, company string, last_update date")
    assert U.needs_refresh(empty, "2021-02-01").first().needs_refresh is True
    info = spark.sql("SELECT 'x' AS code, 'y' AS company, DATE'2021-02-01' AS last_update")
    assert U.needs_refresh(info, "2021-02-01").first().needs_refresh is False
    assert U.needs_refresh(info, "2021-02-02").first().needs_refresh is True


def test_ingest_for_listing_semi_join(spark):
    cur = bars_frame(spark, series_rows("A", [1, 2], start="2020-01-06")) \
        .withColumn("reg_dt", U.stamp("2020-01-01 00:00:00")).withColumn("upd_dt", U.stamp("2020-01-01 00:00:00"))
    staged = bars_frame(spark, series_rows("A", [5, 6, 7], start="2020-01-06")
                        + series_rows("Z", [9], start="2020-01-20"))
    listing = spark.createDataFrame([("A",)], "code string")
    m = U.ingest_for_listing(cur, staged, listing, "2020-01-13", "2021-02-01 17:00:00").toPandas()
    assert set(m.code) == {"A"}
    assert sorted(m.close) == [1, 6, 7]


def test_upsert_rewrites_only_touched_partitions(spark):
    from tickweave.session import scratch_path
    root = scratch_path(spark, "parts")
    cur = spark.createDataFrame([("A", 2019, 1.0), ("A", 2020, 2.0), ("B", 2020, 3.0)],
                                "code string, year int, v double")
    cur.write.partitionBy("year").parquet(f"{root}/v1")
    stored = spark.read.parquet(f"{root}/v1")
    batch = spark.createDataFrame([("A", 2020, 9.0, 1), ("C", 2020, 5.0, 1)],
                                  "code string, year int, v double, _seq int")
    part = U.upsert_partitions(stored.select("code", "year", "v"), batch, ["code", "year"], ["year"])
    assert sorted(map(tuple, part.collect())) == [("A", 2020, 9.0), ("B", 2020, 3.0), ("C", 2020, 5.0)]
    # new snapshot: copy, then replace the touched partition only
    U.write_partitions(stored.select("code", "v", "year"), f"{root}/v2", ["year"])
    U.write_partitions(part.select("code", "v", "year"), f"{root}/v2", ["year"])
    out = sorted(map(tuple, spark.read.parquet(f"{root}/v2").select("code", "year", "v").collect()))
    assert out == [("A", 2019, 1.0), ("A", 2020, 9.0), ("B", 2020, 3.0), ("C", 2020, 5.0)]


def test_incremental_upsert_equals_full_upsert(spark):
    cur = spark.createDataFrame([("A", 2019, 1.0), ("A", 2020, 2.0), ("B", 2020, 3.0), ("B", 2018, 4.0)],
                                "code string, year int, v double")
    batch = spark.createDataFrame([("A", 2020, 9.0, 1), ("C", 2021, 5.0, 1)],
                                  "code string, year int, v double, _seq int")
    full = U.upsert(cur, batch, ["code", "year"])
    inc = U.upsert_incremental(cur, batch, ["code", "year"], ["year"])
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, full.collect()))
    b2 = batch.drop("_seq")
    m_full = U.merge(cur, b2, ["code", "year"], seq=None)
    m_inc = U.merge_incremental(cur, b2, ["year"], lambda c, b: U.merge(c, b, ["code", "year"], seq=None))
    assert sorted(map(tuple, m_inc.collect())) == sorted(map(tuple, m_full.collect()))


def test_returns_aligned_on_chosen_first_code(spark, three):
    uni = three.select("code").distinct()
    rets = P.aligned_returns(three, uni, first="C").toPandas()
    c_dates = sorted(three.filter("code = 'C'").toPandas().date)
    assert sorted(rets.date.unique()) == c_dates          # the index is C's dates


def test_company_info_refresh_is_gated(spark):
    import datetime as dt
    cur = spark.createDataFrame([("000001", "Old", dt.date(2021, 2, 1))], "code string, company string, last_update date")
    listing = spark.createDataFrame([("000001", "New"), ("000002", "Second")], "code string, name string")
    same, refreshed = U.refresh_company_info(cur, listing, "2021-02-01")
    assert not refreshed and [r.company for r in same.collect()] == ["Old"]
    new, refreshed = U.refresh_company_info(cur, listing, "2021-02-02")
    assert refreshed
    assert sorted((r.code, r.company, r.last_update) for r in new.collect()) == [
        ("000001", "New", dt.date(2021, 2, 2)), ("000002", "Second", dt.date(2021, 2, 2))]
