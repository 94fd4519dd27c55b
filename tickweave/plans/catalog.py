"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables (or Spark-derived data from them) and
runs one operator from the inventory over all securities.  Floating outputs
are rounded (``_round``) so that Spark and the SQL oracle compare equal
despite different summation orders.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as C
from ..functions import series as S
from ..operators import indicators as I
from ..operators import momentum as M
from ..operators import portfolio as P
from ..operators import signals as G
from ..operators import upsert as U
from ..sources import fixtures as X
from ..sources import fundamentals as FD
from ..sources import listing as L
from ..sources import market as K
from ..sources import quotes as QP
from ..sources.versions import Versions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# decimal places kept in registered outputs (price-level vs ratio-level values)
PRICE_PLACES = 4
RATIO_PLACES = 6
EWM_PLACES = 4


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _round(df: DataFrame, places: int = RATIO_PLACES, **per_col: int) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), per_col.get(f.name, places)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _bars(spark, sf_dir, freq="week"):
    return X.stored_bars(spark, sf_dir, freq)


def _series(spark, sf_dir, freq="week"):
    return S.open_series(_bars(spark, sf_dir, freq))


BAND_COLS = ["code", "date", "close", "center", "stddev", "upper", "lower"]
PRICE_LEVEL = {c: PRICE_PLACES for c in ("center", "stddev", "upper", "lower", "ma20", "tp")}
EWM_COLS = ("ema60", "ema130", "macd", "signal", "macdhist")
EWM_LEVEL = {c: EWM_PLACES for c in EWM_COLS}


@query("percent_b")
def q_percent_b(spark, sf_dir):
    """§7.2 minimum slice: Bollinger(20, 2) and %B for every code, first 19 rows dropped."""
    s = I.percent_b(I.bollinger(_series(spark, sf_dir)))
    out = S.finish(G.drop_first(s, 19))
    return _round(out.select(*BAND_COLS, "pb"), **PRICE_LEVEL)


@query("sma20")
def q_sma20(spark, sf_dir):
    """W1 20-row moving average of close, NULL until 20 values."""
    return _round(I.sma(_bars(spark, sf_dir), "close", 20).select("code", "date", "close", "ma20"),
                  **PRICE_LEVEL)


@query("bollinger")
def q_bollinger(spark, sf_dir):
    """W2/W3 full-history bands (no trim), as the table-function form does."""
    return _round(I.bollinger(_bars(spark, sf_dir), 20, 2.0).select(*BAND_COLS), **PRICE_LEVEL)


@query("typical_price")
def q_typical_price(spark, sf_dir):
    """W5 (H + L + C) / 3."""
    return _round(I.typical_price(_bars(spark, sf_dir)).select("code", "date", "tp"), **PRICE_LEVEL)


@query("money_flow")
def q_money_flow(spark, sf_dir):
    """W6 truncated positive / negative money flow."""
    out = I.money_flow(I.typical_price(_bars(spark, sf_dir)))
    return out.select("code", "date", "pmf", "nmf")


@query("mfi10")
def q_mfi10(spark, sf_dir):
    """W7 10-row money flow index."""
    return _round(I.mfi(_bars(spark, sf_dir), 10).select("code", "date", "mfi10"))


@query("intraday_intensity")
def q_intraday_intensity(spark, sf_dir):
    """W8 intraday intensity; H = L -> NULL."""
    return _round(I.intraday_intensity(_bars(spark, sf_dir)).select("code", "date", "ii"), ii=PRICE_PLACES)


@query("iip21")
def q_iip21(spark, sf_dir):
    """W9 21-row intraday intensity %."""
    return _round(I.ii_percent(_bars(spark, sf_dir), 21).select("code", "date", "iip21"))


@query("trend_following")
def q_trend_following(spark, sf_dir):
    """W17 buy/sell rows of the %B + MFI trend-following rule."""
    out = G.trend_following(_bars(spark, sf_dir))
    return _round(out.select("code", "date", "close", "pb", "mfi10", "signal"))


@query("reversal")
def q_reversal(spark, sf_dir):
    """W18 buy/sell rows of the %B + II% reversal rule (after dropna)."""
    out = G.reversal(_bars(spark, sf_dir))
    return _round(out.select("code", "date", "close", "pb", "iip21", "signal"))


@query("ewm60")
def q_ewm60(spark, sf_dir):
    """W10 exponentially weighted mean of close, span 60."""
    return _round(I.ewm(_bars(spark, sf_dir), "close", 60, "ema60").select("code", "date", "ema60"),
                  **EWM_LEVEL)


@query("macd")
def q_macd(spark, sf_dir):
    """W11 MACD(60, 130, 45): line, signal line, histogram."""
    out = I.macd(_bars(spark, sf_dir), 60, 130, 45)
    return _round(out.select("code", "date", *EWM_COLS), **EWM_LEVEL)


@query("stochastic")
def q_stochastic(spark, sf_dir):
    """W12–W15 14-row high/low, fast %K, 3-row slow %D on the full history."""
    out = I.stochastic(_bars(spark, sf_dir), 14, 3)
    return _round(out.select("code", "date", "ndays_high", "ndays_low", "fast_k", "slow_d"))


@query("first_screen")
def q_first_screen(spark, sf_dir):
    """W20 first screen: MACD set, dropna, chart columns."""
    out = G.chart_frame(G.first_screen(_bars(spark, sf_dir)),
                        ["code", "date", "open", "high", "low", "close", *EWM_COLS])
    return _round(out, **EWM_LEVEL)


@query("second_screen")
def q_second_screen(spark, sf_dir):
    """W21 second screen: stochastic on the rows the first screen kept, dropna."""
    out = G.second_screen(_bars(spark, sf_dir))
    return _round(out.select("code", "date", "close", "ema130", "ndays_high", "ndays_low",
                             "fast_k", "slow_d"), **EWM_LEVEL)


@query("triple_screen")
def q_triple_screen(spark, sf_dir):
    """W19 triple-screen trades: EMA130 direction + slow %D crossing 20 / 80."""
    out = G.triple_screen(_bars(spark, sf_dir))
    return _round(out.select("code", "date", "close", "ema130", "slow_d", "trade"), **EWM_LEVEL)


# --- security master and scans ------------------------------------------------

SCAN_TOKENS = ["CO BRAND#24", "Brand#3", "CO BRAND#7", "NO SUCH CO"]
BAR_COLS = ["code", "date", "ymd", "open", "high", "low", "close", "volume"]


def _items(spark, sf_dir):
    return X.stored_items(spark, sf_dir)


@query("price_scan")
def q_price_scan(spark, sf_dir):
    """S3/P4 bars of tokens given as code or name, inclusive yyyyMMdd / yyyy-MM-dd range."""
    codes = K.resolve_tokens(K.tokens_frame(spark, SCAN_TOKENS), _items(spark, sf_dir))
    return K.daily_price(_bars(spark, sf_dir), codes, "1996-01-01", "19981231").select(*BAR_COLS)


@query("price_history")
def q_price_history(spark, sf_dir):
    """S5/T1 whole history of every code, ordered by date."""
    return K.price_history(_bars(spark, sf_dir)).select(*BAR_COLS)


@query("resolve_tokens")
def q_resolve_tokens(spark, sf_dir):
    """J1 every name and code of the master (plus lower-cased names, unknown) -> code."""
    items = _items(spark, sf_dir)
    tokens = (items.select(F.col("name").alias("token"))
              .unionByName(items.select(F.col("code").alias("token")))
              .unionByName(items.select(F.lower("name").alias("token")))).distinct()
    return K.resolve_tokens(tokens, items)


@query("active_universe")
def q_active_universe(spark, sf_dir):
    """S6 codes and names with status 'Y'."""
    return K.active_universe(_items(spark, sf_dir))


# --- momentum -------------------------------------------------------------------
RLTV = ("1996-01-03", "1998-12-31", 10)
ABS = ("1999-01-04", "1999-12-31")


@query("asof_day")
def q_asof_day(spark, sf_dir):
    """J4 as-of trading day for every order date (latest bar date on or before it)."""
    orders = X.read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("requested"))
    return M.asof_days(orders, _bars(spark, sf_dir))


@query("two_date_prices")
def q_two_date_prices(spark, sf_dir):
    """J5 close at both snapped dates per code; codes missing either drop."""
    b = _bars(spark, sf_dir, "day")
    return M.two_date_prices(b, M.asof_trading_day(b, RLTV[0]), M.asof_trading_day(b, RLTV[1]))


def _relative(spark, sf_dir):
    return M.relative_momentum(_bars(spark, sf_dir, "day"), _items(spark, sf_dir), *RLTV)


@query("relative_momentum")
def q_relative_momentum(spark, sf_dir):
    """M1/T2 top-10 codes by return 1996-01 .. 1998-12, with company names."""
    return _round(_relative(spark, sf_dir))


@query("absolute_momentum")
def q_absolute_momentum(spark, sf_dir):
    """M2/J6/T3 return of the relative-momentum codes over the next year, all of them."""
    out = M.absolute_momentum(_bars(spark, sf_dir, "day"), _items(spark, sf_dir),
                              _relative(spark, sf_dir), *ABS)
    return _round(out)


@query("momentum_summary")
def q_momentum_summary(spark, sf_dir):
    """A6 mean return of the absolute-momentum selection."""
    out = M.absolute_momentum(_bars(spark, sf_dir, "day"), _items(spark, sf_dir),
                              _relative(spark, sf_dir), *ABS)
    return _round(M.momentum_summary(out))


# --- portfolio ------------------------------------------------------------------
N_CANDIDATES = 20000
WEIGHT_PLACES = 10


_RETURNS: dict[tuple, DataFrame] = {}


def stored_returns(spark, sf_dir):
    """Aligned returns of the master's codes, written once per session and data
    folder (shared by the portfolio reports, like the bars table; μ, Σ and the
    best-row filters are scalar subqueries over it)."""
    from ..session import materialize
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RETURNS:
        rets = P.aligned_returns(_bars(spark, sf_dir), _items(spark, sf_dir).select("code"))
        _RETURNS[key] = materialize(rets, "returns")
    return _RETURNS[key]


def _rets(spark, sf_dir):
    return stored_returns(spark, sf_dir)


@query("daily_returns")
def q_daily_returns(spark, sf_dir):
    """J3/A2/C12 returns on the first code's dates, gaps padded forward."""
    return _round(_rets(spark, sf_dir).select("code", "date", "ret"), ret=10)


@query("annual_return")
def q_annual_return(spark, sf_dir):
    """A1 mean daily return × 252."""
    return _round(P.annual_returns(_rets(spark, sf_dir)))


@query("covariance")
def q_covariance(spark, sf_dir):
    """A3/J8 annualised pairwise-complete sample covariance of all master codes."""
    return _round(P.covariance(_rets(spark, sf_dir)))


@query("candidate_weights")
def q_candidate_weights(spark, sf_dir):
    """M4/F14 20,000 normalised md5-uniform weight vectors over all master codes."""
    uni = P.universe_blocks(_items(spark, sf_dir).select("code"))
    long = P.long_weights(P.candidate_weights(spark, uni, N_CANDIDATES), uni)
    return long.withColumn("weight", F.round("weight", WEIGHT_PLACES))


def _scores(spark, sf_dir):
    rets = _rets(spark, sf_dir)
    uni = P.universe_blocks(_items(spark, sf_dir).select("code"))
    return P.portfolio_scores(P.candidate_weights(spark, uni, N_CANDIDATES), P.annual_returns(rets), P.covariance(rets), uni)


@query("portfolio_scores")
def q_portfolio_scores(spark, sf_dir):
    """M3/F15–F17 return, risk and return/risk of every candidate."""
    return _round(_scores(spark, sf_dir))


@query("portfolio_best")
def q_portfolio_best(spark, sf_dir):
    """M5/P9 candidates of maximum return/risk and of minimum risk."""
    return _round(P.portfolio_best(_scores(spark, sf_dir)))


# --- upserts and ingest ---------------------------------------------------------------

CUT = "1999-01-04"
OLD_TS = "2020-01-01 00:00:00"
RUN_TS = "2021-02-01 17:00:00"
UPSERT_COLS = ["code", "date", "open", "high", "low", "close", "volume"]
AUDIT_COLS = ["reg_dt", "upd_dt"]


def _ts_text(df: DataFrame, cols=AUDIT_COLS) -> DataFrame:
    """Audit stamps as 'yyyy-MM-dd HH:mm:ss' text for engine-neutral comparison."""
    return df.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _with_audit(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("reg_dt", U.stamp(ts)).withColumn("upd_dt", U.stamp(ts))


@query("upsert_replace")
def q_upsert_replace(spark, sf_dir):
    """U1/K3 full-row replace by (code, date): restated overlap, new weeks, a key twice."""
    current, batch = X.upsert_pair(_bars(spark, sf_dir), CUT)
    # only the year partitions the batch touches are shuffled by key
    return U.upsert_incremental(current, batch, ["code", "date"], ["year"]).select(*UPSERT_COLS)


@query("merge_bars")
def q_merge_bars(spark, sf_dir):
    """U2/K5 MERGE by (code, date): matched rows keep reg_dt and get upd_dt; the stored bars are bucketed and not shuffled."""
    current, batch = X.upsert_pair(_bars(spark, sf_dir), CUT)
    stored = X.stored_bucketed_bars(spark, sf_dir, CUT, lambda: _with_audit(current, OLD_TS))
    return _ts_text(stored.after(batch, U.merge_bars, RUN_TS).select(*UPSERT_COLS, *AUDIT_COLS))


@query("merge_bars_by_year")
def q_merge_bars_by_year(spark, sf_dir):
    """U2/K5 the same MERGE over bars that are partitioned by year alone: the touched years are shuffled by key."""
    current, batch = X.upsert_pair(_bars(spark, sf_dir), CUT)
    merged = U.merge_incremental(_with_audit(current, OLD_TS), batch, ["year"], U.merge_bars, RUN_TS)
    return _ts_text(merged.select(*UPSERT_COLS, *AUDIT_COLS))


@query("upsert_bucketed")
def q_upsert_bucketed(spark, sf_dir):
    """U1/K3 full-row replace written into bucketed bars, through the journal, and read back."""
    current, batch = X.upsert_pair(_bars(spark, sf_dir), CUT)
    return X.bucketed_bars(spark, current).apply(batch, U.replace_bars).select(*UPSERT_COLS)


@query("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    """R1/U2 the upsert batch arriving as staged files, merged by a streaming query with audit stamps."""
    current, batch = X.upsert_pair(_bars(spark, sf_dir), CUT)
    cut = F.lit(CUT).cast("date")
    first = batch.filter((F.col("_seq") == 1) & (F.col("date") < cut))
    second = batch.filter((F.col("_seq") == 1) & (F.col("date") >= cut))
    third = batch.filter(F.col("_seq") == 2)
    out = X.replay_upserts(spark, _with_audit(current, OLD_TS), [first, second, third], ts=RUN_TS)
    return _ts_text(out.select(*UPSERT_COLS, *AUDIT_COLS))


def _listing(spark, sf_dir):
    return L.read_listing(X.listing_raw(spark, sf_dir))


@query("listing_clean")
def q_listing_clean(spark, sf_dir):
    """S7/S8/F1 listing download -> zero-padded codes and canonical columns."""
    return _listing(spark, sf_dir)


@query("merge_items")
def q_merge_items(spark, sf_dir):
    """U2/K4 item master MERGE: sizes 1-25 stored, sizes 20-50 arrive renamed."""
    raw = X.listing_raw(spark, sf_dir)
    current = (L.listing_to_items(L.read_listing(raw.filter(F.col("size") <= 25)), "20210101")
               .withColumn("reg_dt", U.stamp(OLD_TS)).withColumn("upd_dt", F.lit(None).cast("timestamp")))
    batch = L.listing_to_items(L.read_listing(raw.filter(F.col("size") >= 20)), "20210201") \
             .withColumn("name", F.upper("name"))
    return _ts_text(U.merge_items(current, batch, RUN_TS))


@query("needs_refresh")
def q_needs_refresh(spark, sf_dir):
    """A7 staleness gate of the company master on 2021-03-01."""
    return U.needs_refresh(X.company_info(spark, sf_dir), "2021-03-01")


@query("company_info_replace")
def q_company_info_replace(spark, sf_dir):
    """K2 REPLACE of (code, company, last_update) from the full listing."""
    info = X.company_info(spark, sf_dir)
    return U.replace_company_info(info.filter(F.col("size") <= 25), _listing(spark, sf_dir), "2021-02-01")


@query("ingest_filtered")
def q_ingest_filtered(spark, sf_dir):
    """K7 bars since a date for the codes of the active listing, merged by K5."""
    b = _bars(spark, sf_dir)
    current = _with_audit(b.filter(F.col("date") < F.lit(CUT).cast("date")), OLD_TS)
    staged = b.withColumn("close", F.col("close") + 1)
    listing = K.active_universe(_items(spark, sf_dir))
    merged = U.ingest_for_listing(current, staged, listing, "1998-12-07", RUN_TS)
    return _ts_text(merged.select(*UPSERT_COLS, *AUDIT_COLS))


@query("ingest_chain")
def q_ingest_chain(spark, sf_dir):
    """K7 the whole chain in one commit: the listing refreshes the master, then its codes' bars arrive; both tables as rows."""
    from ..session import scratch_path
    raw = X.brand_listing(spark, sf_dir)
    items = (L.listing_to_items(L.read_listing(raw.filter(F.col("size") <= 15)), "20210101")
             .withColumn("reg_dt", U.stamp(OLD_TS)).withColumn("upd_dt", F.lit(None).cast("timestamp")))
    b = _bars(spark, sf_dir).withColumn("code", X.listing_code("code"))
    current = _with_audit(b.filter(F.col("date") < F.lit(CUT).cast("date")), OLD_TS)
    staged = b.withColumn("close", F.col("close") + 1)
    versions = Versions(spark, scratch_path(spark, "chain"))
    master, bars = U.commit_listing_then_bars(versions, 1, items, raw.filter((F.col("size") >= 10) & (F.col("size") <= 20)).withColumn("company", F.upper("company")),
                                              current, staged, "20210201", "1998-12-07", RUN_TS)
    rows = master.select(F.lit("item").alias("kind"), "code", "name", "ymd", F.lit(None).cast("string").alias("bar"), *AUDIT_COLS)
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")])
    return _ts_text(rows.unionByName(bars.select(F.lit("bar").alias("kind"), "code", F.lit(None).cast("string").alias("name"), "ymd", text.alias("bar"), *AUDIT_COLS)))


@query("create_tables")
def q_create_tables(spark, sf_dir):
    """K1 the company table made empty on first use, filled, and found again as it is."""
    from ..schemas import COMPANY_INFO
    from ..session import scratch_path
    path = scratch_path(spark, "tables")
    empty = U.ensure_table(spark, path, COMPANY_INFO)
    U.replace_company_info(empty, _listing(spark, sf_dir), "2021-02-01").write.mode("append").parquet(path)
    return U.ensure_table(spark, path, COMPANY_INFO)


@query("measure_clean")
def q_measure_clean(spark, sf_dir):
    """F8/F9 scraped measure text -> number ('N/A' -> 0, '' -> 0, commas dropped)."""
    t = X.measure_text(spark, sf_dir)
    return t.select("key", "text", C.clean_measure(C.empty_to_zero(F.col("text"))).alias("value"))


@query("fundamentals_pivot")
def q_fundamentals_pivot(spark, sf_dir):
    """J9/F6/F7 statement cells -> one row per (code, ym, gb) with 28 measures."""
    return FD.cells_to_rows(X.stored_fin_cells(spark, sf_dir))


@query("statement_pages")
def q_statement_pages(spark, sf_dir):
    """S13 staged statement pages parsed into fundamentals."""
    return FD.extract_fundamentals(X.stored_statement_pages(spark, sf_dir))


@query("merge_fundamentals")
def q_merge_fundamentals(spark, sf_dir):
    """U2/K6 fundamentals MERGE: every column (reg_dt too) overwritten on match; only the batch's years are shuffled."""
    current = FD.with_audit(X.stored_fundamentals(spark, sf_dir).filter(F.col("year") < 2000), OLD_TS)
    arriving = X.stored_fin_cells(spark, sf_dir).filter(C.period_to_ym("period_header") >= "1999")
    batch = FD.with_year(FD.cells_to_rows(arriving)).withColumn("SALES", F.col("SALES") + 1)
    return _ts_text(U.merge_incremental(current, batch, ["year"], U.merge_fundamentals, RUN_TS).drop("year"))


@query("html_quotes")
def q_html_quotes(spark, sf_dir):
    """S9/D6 every staged quote page (10 rows a page, newest first) parsed into bars."""
    return QP.extract_quotes(X.stored_quote_pages(spark, sf_dir))


@query("html_quotes_capped")
def q_html_quotes_capped(spark, sf_dir):
    """T4 the same with a cap of 5 pages a code, applied before the parse."""
    return QP.extract_quotes(X.stored_quote_pages(spark, sf_dir), pages_to_fetch=5)


# --- remaining inventory items ---------------------------------------------------------
@query("chart_frame")
def q_chart_frame(spark, sf_dir):
    """W22 chart inputs: OHLC, volume and Bollinger bands after the 19-row trim."""
    s = I.bollinger(_series(spark, sf_dir))
    out = S.finish(G.drop_first(s, 19))
    return _round(G.chart_frame(out, ["code", "date", "open", "high", "low", "close", "volume",
                                      "center", "upper", "lower"]), **PRICE_LEVEL)


@query("vendor_bars")
def q_vendor_bars(spark, sf_dir):
    """S11/S12 staged vendor OHLCV files (with Adj Close) read back since a date."""
    from ..session import materialize
    b = _bars(spark, sf_dir)
    vendor = b.select("code", F.col("date").alias("Date"),
                      *[F.col(a).cast("double").alias(v) for a, v in
                        (("open", "Open"), ("high", "High"), ("low", "Low"), ("close", "Close"))],
                      (F.col("close") * F.lit(0.5)).alias("Adj Close"),
                      F.col("volume").cast("double").alias("Volume"))
    staged = materialize(vendor, "vendor")
    path = staged.inputFiles()[0].rsplit("/", 1)[0]
    out = L.read_vendor_bars(spark, path, "2000-01-01", adj=True)
    return out.select("code", "date", "ymd", "open", "high", "low", "close", "volume", "adj_close")


@query("ingest_quotes")
def q_ingest_quotes(spark, sf_dir):
    """K8/K3 quote pages of the active codes replace their bars, ``diff`` included."""
    current = _bars(spark, sf_dir).filter(F.col("date") < F.lit(CUT).cast("date"))
    out = QP.ingest_quotes(current, X.stored_quote_pages(spark, sf_dir), K.active_universe(_items(spark, sf_dir)))
    return out.select(*UPSERT_COLS, F.col("diff").cast("string").alias("diff"))  # as text: stored bars have none


@query("ingest_fundamentals")
def q_ingest_fundamentals(spark, sf_dir):
    """K9 statements of every active code in one job; unparseable cells set aside."""
    rows, _bad = FD.ingest_fundamentals(X.stored_fin_cells(spark, sf_dir), K.active_universe(_items(spark, sf_dir)))
    return rows


@query("fundamentals_quarantine")
def q_fundamentals_quarantine(spark, sf_dir):
    """K9 the cells of active codes that no number can be read from."""
    _rows, bad = FD.ingest_fundamentals(X.stored_fin_cells(spark, sf_dir), K.active_universe(_items(spark, sf_dir)))
    return bad


@query("read_items")
def q_read_items(spark, sf_dir):
    """S1 code and name of every security."""
    return K.read_items(_items(spark, sf_dir))


@query("read_company_info")
def q_read_company_info(spark, sf_dir):
    """S2 code and company of the simple master."""
    return K.read_company_info(X.company_info(spark, sf_dir))


@query("price_raw")
def q_price_raw(spark, sf_dir):
    """S4 one code between two text bounds, no checks or defaults."""
    return K.daily_price_raw(_bars(spark, sf_dir), "Brand#3", "19960101", "19981231").select(*BAR_COLS)


@query("price_last_year")
def q_price_last_year(spark, sf_dir):
    """S3/F5 the 365 days up to a day, the default range of the price scan."""
    codes = K.active_universe(_items(spark, sf_dir))
    return K.daily_price(_bars(spark, sf_dir), codes, as_of=dt.date(1998, 12, 31)).select(*BAR_COLS)


@query("listing_simple")
def q_listing_simple(spark, sf_dir):
    """S7 the two-column listing."""
    return L.read_listing(X.listing_raw(spark, sf_dir), full=False)


@query("ymd_dates")
def q_ymd_dates(spark, sf_dir):
    """F3/F2 the dates of the bars' yyyyMMdd text."""
    return _bars(spark, sf_dir).select("code", "ymd", C.ymd_to_date("ymd").alias("parsed"))


@query("company_info_refresh")
def q_company_info_refresh(spark, sf_dir):
    """K2/A7 the gated replace: the master is stale on the day, so the listing replaces it."""
    info = X.company_info(spark, sf_dir)
    return U.refresh_company_info(info.filter(F.col("size") <= 25), _listing(spark, sf_dir), "2021-02-01")[0]


@query("percent_b_scaled")
def q_percent_b_scaled(spark, sf_dir):
    """F18 %B times 100, as the chart shows it."""
    s = I.percent_b(I.bollinger(_series(spark, sf_dir)))
    return _round(S.finish(G.drop_first(s, 19)).select("code", "date", (F.col("pb") * 100).alias("pb_percent")))


@query("ewm_gaps")
def q_ewm_gaps(spark, sf_dir):
    """W10 over closes with gaps, at spans 1, 2 and 60: the mean is carried through missing days."""
    b = _bars(spark, sf_dir).select("code", "date", F.when(F.col("volume") % 3 != 0, F.col("close")).alias("close"))
    s = S.ewm_many(S.open_series(b), [("close", 1, "ema1"), ("close", 2, "ema2"), ("close", 60, "ema60")])
    return _round(S.finish(s).select("code", "date", "ema1", "ema2", "ema60"), ema1=EWM_PLACES, ema2=EWM_PLACES, ema60=EWM_PLACES)
