"""Portfolio statistics and candidate scoring.

The source builds a date × security close matrix for a handful of
securities, then scores 20,000 random weight vectors in a Python loop.
Here the universe is a DataFrame of codes, dealt by hash into blocks of some
256.  Returns stay long (code, k, ret); the covariance is accumulated for
pairs of blocks with numpy; candidates hold one row of weights a block, and
their risk is a blocked matrix product: tasks hold one pair of blocks and one
chunk of candidates, and add a partial wᵀΣw per candidate.  No row, task or
driver holds N values, let alone N².
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import series as S
from ..session import materialize

TRADING_DAYS = 252


def universe_codes(universe: DataFrame) -> DataFrame:
    """Universe as distinct codes; every array over it is in code order."""
    return universe.select("code").distinct()


def universe_blocks(universe: DataFrame) -> DataFrame:
    """(block, codes, n_blocks): the universe dealt into blocks of some ``BLOCK`` codes, each in code order.

    Written once, so that weights, statistics and scores share it; a universe
    that is in blocks already is returned as it is.
    """
    if "codes" in universe.columns:
        return universe
    codes = universe_codes(universe)
    n = _n_blocks(codes)
    dealt = codes.withColumn("n_blocks", n).select(F.pmod(F.xxhash64("code"), F.col("n_blocks")).cast("int").alias("block"), "code", "n_blocks")
    return materialize(dealt.groupBy("block", "n_blocks").agg(F.sort_array(F.collect_list("code")).alias("codes")).select("block", "codes", "n_blocks"), "universe")


def _n_blocks(codes: DataFrame) -> Column:
    """The number of blocks that distinct ``codes`` are dealt into (scalar)."""
    return codes.select(F.greatest(F.ceil(F.count("code") / BLOCK), F.lit(1)).cast("int")).scalar()


def _first_code(universe: DataFrame):
    return universe.select(F.min("code")).scalar()


def aligned_returns(bars: DataFrame, universe: DataFrame, first: str | None = None) -> DataFrame:
    """J3 + A2: daily returns of each universe code on the first code's dates.

    ``first`` is the security whose trading dates form the index (the first
    of the caller's list); by default the smallest code of the universe.

    Later series are re-indexed onto the first security's trading dates
    (extra dates drop, missing dates become gaps); gaps are padded forward
    before differencing, so a missing day gives a 0 return.  A code's rows begin
    at its first aligned date, whose return is NULL.  Output: code, k (date
    index), date, ret.
    """
    codes = universe_codes(universe)
    first = F.lit(first) if first is not None else _first_code(codes)
    idx = S.open_series(bars.filter(F.col("code") == first).select("code", "date")).select(F.col("_rn").alias("k"), "date")
    n_idx = idx.select(F.max("k")).scalar()
    present = (bars.join(codes, "code", "left_semi").join(idx, "date", "inner")
                   .select("code", "k", "date", "close"))
    # grid rows from each code's first aligned index onwards (explode of a range per code)
    first_k = present.groupBy("code").agg(F.min("k").alias("_k0"))
    grid = (first_k.select("code", F.explode(F.sequence(F.col("_k0"), n_idx)).alias("k"))
                   .join(idx, "k", "inner"))
    g = grid.join(present.select("code", "k", "close"), ["code", "k"], "left")
    s = S.forward_fill(g, "close", "_ff", order="k")
    prev = S.lag("_ff", order="k")
    s = s.withColumn("ret", F.try_divide(F.col("_ff").cast("double"), prev.cast("double")) - F.lit(1.0))
    return s.select("code", "k", "date", "ret")


def annual_returns(rets: DataFrame) -> DataFrame:
    """A1 mean daily return × 252 per code (NULL returns skipped)."""
    return rets.groupBy("code").agg((F.avg("ret") * F.lit(float(TRADING_DAYS))).alias("annual_ret"))


#: Codes of a block (on average), dates of a covariance part, parts combined at a time, weights of a chunk of candidates.
BLOCK = 256
PART_DATES = 1024
FAN_IN = 16
CHUNK_WEIGHTS = 1 << 20


def _centred(x: np.ndarray, y: np.ndarray):
    """Pairwise-complete n, means and centred co-moments of the columns of x and y."""
    mx, my = ~np.isnan(x), ~np.isnan(y)
    # shifted by each column's mean first, so that large means cost no digits
    cx, cy = (np.where(m.any(0), np.where(m, v, 0).sum(0) / np.maximum(1, m.sum(0)), 0.0) for v, m in ((x, mx), (y, my)))
    x0, y0 = np.where(mx, x - cx, 0.0), np.where(my, y - cy, 0.0)
    fx, fy = mx.astype(float), my.astype(float)
    n = fx.T @ fy
    with np.errstate(invalid="ignore", divide="ignore"):
        ax, ay = x0.T @ fy / n, fx.T @ y0 / n
        moment = x0.T @ y0 - n * ax * ay
    return n, cx[:, None] + ax, cy[None, :] + ay, np.where(n > 0, moment, 0.0)


def _combine(a, b):
    """Co-moments of two disjoint sets of dates."""
    na, xa, ya, ma = a
    nb, xb, yb, mb = b
    n = na + nb
    with np.errstate(invalid="ignore", divide="ignore"):
        dx, dy = xb - xa, yb - ya
        moment = ma + mb + np.where((na > 0) & (nb > 0), dx * dy * na * nb / n, 0.0)
        x = np.where(na == 0, xb, np.where(nb == 0, xa, xa + dx * nb / n))
        y = np.where(na == 0, yb, np.where(nb == 0, ya, ya + dy * nb / n))
    return n, x, y, moment


PART = "bi int, bj int, part int, rows array<string>, cols array<string>, stats binary"


def _part_bytes(stats, diagonal: bool) -> bytes:
    """Four statistics of a block pair; a pair of a block with itself as packed upper triangles."""
    stats = np.stack(stats)
    return (stats[:, *np.triu_indices(stats.shape[1])] if diagonal else stats).tobytes()


def _part_stats(blob: bytes, n_rows: int, n_cols: int, diagonal: bool) -> np.ndarray:
    if not diagonal:
        return np.frombuffer(blob).reshape(4, n_rows, n_cols)
    upper = np.triu_indices(n_rows)
    out = np.empty((4, n_rows, n_rows))
    flat = np.frombuffer(blob).reshape(4, -1)
    # n and the moments are symmetric; the mean of a row's code over common dates is the transposed mean of the column's
    for k, mirror in enumerate((0, 2, 1, 3)):
        out[k].T[upper] = flat[mirror]
        out[k][upper] = flat[k]
    return out


def _block_part(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Co-moments of one pair of blocks over one part of the dates, for the codes present."""
    bi, bj, part = key
    wide = pdf.pivot(index="k", columns=["b", "code"], values="ret")
    x, y = (wide[b].sort_index(axis=1) for b in (bi, bj)) if {bi, bj} <= set(wide.columns.get_level_values(0)) else (None, None)
    if x is None:
        return pd.DataFrame(columns=["bi", "bj", "part", "rows", "cols", "stats"])
    stats = _centred(x.to_numpy(dtype=float), y.to_numpy(dtype=float))
    return pd.DataFrame({"bi": [bi], "bj": [bj], "part": [part // FAN_IN], "rows": [list(x.columns)], "cols": [list(y.columns)],
                         "stats": [_part_bytes(stats, bi == bj)]})


def _widened(stats: np.ndarray, rows, cols, all_rows: dict, all_cols: dict) -> np.ndarray:
    if len(rows) == len(all_rows) and len(cols) == len(all_cols):
        return stats
    out = np.zeros((4, len(all_rows), len(all_cols)))
    out[:, [[all_rows[c]] for c in rows], [all_cols[c] for c in cols]] = stats
    return out


def _combined(pdf: pd.DataFrame, diagonal: bool):
    """(row codes, column codes, statistics) over several parts, combined two by two."""
    all_rows, all_cols = ({c: i for i, c in enumerate(sorted({c for codes in pdf[side] for c in codes}))} for side in ("rows", "cols"))
    level = [_widened(_part_stats(b, len(r), len(c), diagonal), r, c, all_rows, all_cols) for r, c, b in zip(pdf["rows"], pdf["cols"], pdf["stats"])]
    while len(level) > 1:
        level = [np.stack(_combine(a, b)) for a, b in zip(level[::2], level[1::2])] + level[len(level) // 2 * 2:]
    return list(all_rows), list(all_cols), level[0]


def _block_merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Up to ``FAN_IN`` parts of a block pair as one."""
    bi, bj, part = key
    rows, cols, stats = _combined(pdf, bi == bj)
    return pd.DataFrame({"bi": [bi], "bj": [bj], "part": [0], "rows": [rows], "cols": [cols], "stats": [_part_bytes(stats, bi == bj)]})


def _block_sum(key, pdf: pd.DataFrame) -> pd.DataFrame:
    bi, bj = key
    rows, cols, (n, _, _, moment) = _combined(pdf, bi == bj)
    i, j = np.nonzero(n >= 1)
    cov = np.full(len(i), np.nan)
    enough = n[i, j] >= 2
    cov[enough] = moment[i, j][enough] / (n[i, j][enough] - 1) * TRADING_DAYS
    out = pd.DataFrame({"code_i": np.array(rows, object)[i], "code_j": np.array(cols, object)[j], "cov": cov})
    return out if bi == bj else pd.concat([out, out.rename(columns={"code_i": "code_j", "code_j": "code_i"})[["code_i", "code_j", "cov"]]])


def covariance(rets: DataFrame) -> DataFrame:
    """A3/J8 annualised sample covariance, pairwise complete (pandas ``cov``).

    Codes are dealt into blocks, dates cut into parts; one task holds one pair
    of blocks over one part of the dates, and only upper pairs are computed.
    Parts leave centred co-moments of the codes present (packed triangles where
    a block meets itself), which a tree of combinations brings together.
    Output: code_i, code_j, cov (NULL below two common dates).
    """
    valid = rets.filter(F.col("ret").isNotNull()).select("code", "k", "ret")
    dealt = valid.withColumn("_n", _n_blocks(valid.select("code").distinct()))
    dealt = dealt.select("code", "k", "ret", "_n", F.pmod(F.xxhash64("code"), F.col("_n")).cast("int").alias("b"))
    # a block meets every block: as row block from itself on, as column block before
    pairs = F.transform(F.sequence(F.lit(0), F.col("_n") - 1),
                        lambda o: F.struct(F.least(F.col("b"), o).alias("bi"), F.greatest(F.col("b"), o).alias("bj")))
    part = F.floor(F.col("k") / PART_DATES).cast("int").alias("part")
    rows = dealt.withColumn("p", F.explode(pairs)).select("p.bi", "p.bj", part, "b", "code", "k", "ret")
    parts = rows.groupBy("bi", "bj", "part").applyInPandas(_block_part, PART)
    merged = parts.groupBy("bi", "bj", "part").applyInPandas(_block_merge, PART)
    found = merged.groupBy("bi", "bj").applyInPandas(_block_sum, "code_i string, code_j string, cov double")
    return found.select("code_i", "code_j", F.when(~F.isnan("cov"), F.col("cov")).alias("cov"))


def _uniform(id_col, code_col):
    """Deterministic uniform in [0, 1): first 8 hex digits of md5('<id>-<code>') / 2^32."""
    h = F.substring(F.md5(F.concat(id_col.cast("string"), F.lit("-"), code_col)), 1, 8)
    return F.conv(h, 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)


def candidate_weights(spark: SparkSession, universe: DataFrame, n: int = 20000) -> DataFrame:
    """M4/F14 ``n`` normalised weight vectors: (portfolio_id, block, weights), one row a block of the universe.

    ``weights`` follow the block's codes (``universe_blocks``), so a row holds
    some ``BLOCK`` numbers however large the universe is.  Uniforms come from
    md5 of (id, code), so a vector does not depend on partitioning or on the
    engine that computes it.
    """
    ids = spark.range(n).select(F.col("id").alias("portfolio_id"))
    # every id with every block: an equi join on a block number that both sides enumerate
    blocks = universe_blocks(universe)
    n_blocks = blocks.select(F.max("n_blocks")).scalar()
    ids = ids.withColumn("_n", n_blocks).select("portfolio_id", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("block"))
    raw = ids.join(blocks, "block").select("portfolio_id", "block", F.transform("codes", lambda c: _uniform(F.col("portfolio_id"), c)).alias("_u"))
    total = F.sum(F.aggregate(F.col("_u"), F.lit(0.0), lambda acc, x: acc + x)).over(Window.partitionBy("portfolio_id"))
    return raw.withColumn("_total", total).select("portfolio_id", "block", F.transform("_u", lambda x: x / F.col("_total")).alias("weights"))


def long_weights(weights: DataFrame, universe: DataFrame) -> DataFrame:
    """Candidates as (portfolio_id, code, weight)."""
    named = weights.join(universe_blocks(universe), "block").select("portfolio_id", F.explode(F.arrays_zip("codes", "weights")).alias("cw"))
    return named.select("portfolio_id", F.col("cw.codes").alias("code"), F.col("cw.weights").alias("weight"))


def _statistics(annual: DataFrame, cov: DataFrame, universe: DataFrame) -> DataFrame:
    """(bi, bj, n_i, n_j, sigma, mu): Σ of each upper pair of blocks as (place, place, value), μ of a block with itself.

    Statistics are matched by code; codes outside the universe are left out,
    and what the universe has and the statistics lack stays missing.
    """
    blocks = universe_blocks(universe)
    place = blocks.select("block", F.posexplode("codes").alias("at", "code"))
    side = (lambda s: place.select(F.col("block").alias(f"b{s}"), F.col("at").alias(f"at_{s}"), F.col("code").alias(f"code_{s}")))
    entries = cov.join(side("i"), "code_i").join(side("j"), "code_j").where(F.col("bi") <= F.col("bj"))
    sigma = entries.groupBy("bi", "bj").agg(F.collect_list(F.struct("at_i", "at_j", "cov")).alias("sigma"))
    mu = annual.join(place, "code").groupBy("block").agg(F.collect_list(F.struct("at", "annual_ret")).alias("mu"))
    size = blocks.select("block", F.size("codes").alias("n"), "n_blocks")
    pairs = size.select(F.col("block").alias("bi"), F.col("n").alias("n_i"), F.explode(F.sequence(F.col("block"), F.col("n_blocks") - 1)).alias("bj"))
    pairs = pairs.join(size.select(F.col("block").alias("bj"), F.col("n").alias("n_j")), "bj")
    return pairs.join(sigma, ["bi", "bj"], "left").join(mu.withColumnRenamed("block", "bi"), "bi", "left").select("bi", "bj", "n_i", "n_j", "sigma", "mu")


def _score_pair(weights: pd.DataFrame, stats: pd.DataFrame) -> pd.DataFrame:
    """A chunk's partial wᵀΣw over one pair of blocks, and w·μ over a block with itself."""
    names = ["portfolio_id", "risk", "returns"]
    if weights.empty or stats.empty:
        return pd.DataFrame(columns=names)
    s = stats.iloc[0]
    sigma = np.full((s["n_i"], s["n_j"]), np.nan)
    if s["sigma"] is not None:
        i, j, v = zip(*[(e["at_i"], e["at_j"], e["cov"]) for e in s["sigma"]])
        sigma[list(i), list(j)] = np.array(v, float)
    left = weights[weights["block"] == s["bi"]].sort_values("portfolio_id")
    w = np.stack(left["weights"].to_numpy())
    if s["bi"] != s["bj"]:
        right = weights[weights["block"] == s["bj"]].sort_values("portfolio_id")
        v = np.stack(right["weights"].to_numpy())
        return pd.DataFrame({"portfolio_id": left["portfolio_id"].to_numpy(), "risk": 2 * ((w @ sigma) * v).sum(1), "returns": 0.0})
    mu = np.full(s["n_i"], np.nan)
    for e in s["mu"] if s["mu"] is not None else ():
        mu[e["at"]] = np.nan if e["annual_ret"] is None else e["annual_ret"]
    return pd.DataFrame({"portfolio_id": left["portfolio_id"].to_numpy(), "risk": ((w @ sigma) * w).sum(1), "returns": w @ mu})


def portfolio_scores(weights: DataFrame, annual: DataFrame, cov: DataFrame,
                     universe: DataFrame) -> DataFrame:
    """M3/F15–F17 expected return w·μ, risk sqrt(wᵀΣw) and ratio return/risk of each candidate.

    ``weights`` are blocked (``candidate_weights``).  Chunks of candidates meet
    the upper pairs of blocks; a candidate with a weight on a code without
    statistics has NULL scores.
    """
    blocks = universe_blocks(universe)
    n_blocks = blocks.select(F.max("n_blocks")).scalar()
    # candidates of one block: what a chunk is counted from
    count = weights.where("block = 0").agg(F.count(F.lit(1)).alias("n"))
    chunks = count.select(F.greatest(F.ceil(F.col("n") * BLOCK / CHUNK_WEIGHTS), F.lit(1)).cast("int")).scalar()
    own = weights.withColumns({"_c": chunks, "_n": n_blocks})
    pairs = F.transform(F.sequence(F.lit(0), F.col("_n") - 1),
                        lambda o: F.struct(F.least(F.col("block"), o).alias("bi"), F.greatest(F.col("block"), o).alias("bj")))
    dealt = own.withColumn("p", F.explode(pairs)).select("p.bi", "p.bj", F.pmod(F.xxhash64("portfolio_id"), F.col("_c")).cast("int").alias("chunk"),
                                                         "block", "portfolio_id", "weights")
    stats = _statistics(annual, cov, blocks).withColumn("_c", chunks)
    stats = stats.select("bi", "bj", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)).alias("chunk"), "n_i", "n_j", "sigma", "mu")
    keys = ["bi", "bj", "chunk"]
    parts = dealt.groupBy(*keys).cogroup(stats.groupBy(*keys)).applyInPandas(_score_pair, "portfolio_id long, risk double, returns double")
    total = parts.groupBy("portfolio_id").agg(F.sum("returns").alias("returns"), F.sqrt(F.sum("risk")).alias("risk"))
    known = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("returns", "risk")]
    return total.select("portfolio_id", *known).withColumn("sharpe", F.try_divide(F.col("returns"), F.col("risk")))


def portfolio_best(scores: DataFrame) -> DataFrame:
    """M5/P9 rows of maximum ratio and of minimum risk (ties all kept).

    The scores are written once; one aggregate gives both extremes, one join marks their rows.
    """
    scores = materialize(scores, "scores")
    best = scores.agg(F.max("sharpe").alias("_top"), F.min("risk").alias("_low"))
    # one row
    marked = scores.join(F.broadcast(best), (F.col("sharpe") == F.col("_top")) | (F.col("risk") == F.col("_low")))
    kinds = F.array_compact(F.array(F.when(F.col("sharpe") == F.col("_top"), F.lit("max_sharpe")), F.when(F.col("risk") == F.col("_low"), F.lit("min_risk"))))
    return marked.withColumn("kind", F.explode(kinds)).drop("_top", "_low")
