"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Written from the operator definitions, not from the Spark code: windows are
plain ``PARTITION BY code ORDER BY date`` frames, EWM is a recursive CTE.
Tables ``lineitem part customer ...`` are the driver's parquet views.
"""

from __future__ import annotations

from ..schemas import MEASURE_HEADERS, MEASURES

PRICE_PLACES = 4
RATIO_PLACES = 6

BARS_CTE = """
bars AS (
  SELECT p_brand AS code,
         CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS date,
         strftime(CAST(date_trunc('{unit}', l_shipdate) AS DATE), '%Y%m%d') AS ymd,
         arg_min(floor(l_extendedprice)::BIGINT,
                 row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS open,
         max(floor(l_extendedprice)::BIGINT) AS high,
         min(floor(l_extendedprice)::BIGINT) AS low,
         arg_max(floor(l_extendedprice)::BIGINT,
                 row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS close,
         CAST(NULL AS BIGINT) AS diff,
         sum(floor(l_quantity))::BIGINT AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3
)"""


def bars_cte(freq: str = "week") -> str:
    return BARS_CTE.format(unit="week" if freq == "week" else "day")


ORACLE: dict[str, str] = {}

ORACLE["percent_b"] = f"""
WITH {bars_cte()},
w AS (
  SELECT code, date, close,
         row_number() OVER (PARTITION BY code ORDER BY date) AS rn,
         CASE WHEN count(close) OVER f = 20 THEN avg(close::DOUBLE) OVER f END AS center,
         CASE WHEN count(close) OVER f = 20 THEN stddev_samp(close::DOUBLE) OVER f END AS stddev
  FROM bars
  WINDOW f AS (PARTITION BY code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
)
SELECT code, date, close,
       round(center, {PRICE_PLACES}) AS center, round(stddev, {PRICE_PLACES}) AS stddev,
       round(center + 2 * stddev, {PRICE_PLACES}) AS upper,
       round(center - 2 * stddev, {PRICE_PLACES}) AS lower,
       round((close - (center - 2 * stddev)) / nullif((center + 2 * stddev) - (center - 2 * stddev), 0),
             {RATIO_PLACES}) AS pb
FROM w WHERE rn > 19
"""

EWM_PLACES = 4


def _r(expr: str, places: int = RATIO_PLACES) -> str:
    return f"round({expr}, {places})"


# rolling frames of n rows: NULL until n valid values (pandas rolling)
def _roll(agg: str, col: str, n: int, frame: str) -> str:
    return f"CASE WHEN count({col}) OVER {frame} = {n} THEN {agg}({col}) OVER {frame} END"


BANDS = f"""
bands AS (
  SELECT code, date, open, high, low, close, volume,
         row_number() OVER (PARTITION BY code ORDER BY date) AS rn,
         {_roll('avg', 'close::DOUBLE', 20, 'f20')} AS center,
         {_roll('stddev_samp', 'close::DOUBLE', 20, 'f20')} AS stddev
  FROM bars
  WINDOW f20 AS (PARTITION BY code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
),
bands2 AS (
  SELECT *, center + stddev * 2.0 AS upper, center - stddev * 2.0 AS lower,
         (close - (center - stddev * 2.0)) / nullif((center + stddev * 2.0) - (center - stddev * 2.0), 0) AS pb
  FROM bands
)"""

ORACLE["sma20"] = f"""
WITH {bars_cte()}
SELECT code, date, close,
       {_r(_roll('avg', 'close::DOUBLE', 20, 'f20'), PRICE_PLACES)} AS ma20
FROM bars
WINDOW f20 AS (PARTITION BY code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
"""

ORACLE["bollinger"] = f"""
WITH {bars_cte()}, {BANDS}
SELECT code, date, close, {_r('center', PRICE_PLACES)} AS center, {_r('stddev', PRICE_PLACES)} AS stddev,
       {_r('upper', PRICE_PLACES)} AS upper, {_r('lower', PRICE_PLACES)} AS lower
FROM bands2
"""

ORACLE["typical_price"] = f"""
WITH {bars_cte()}
SELECT code, date, {_r('(high::DOUBLE + low::DOUBLE + close::DOUBLE) / 3.0', PRICE_PLACES)} AS tp FROM bars
"""

FLOWS = """
tp AS (
  SELECT code, date, open, high, low, close, volume,
         (high::DOUBLE + low::DOUBLE + close::DOUBLE) / 3.0 AS tp,
         row_number() OVER (PARTITION BY code ORDER BY date) AS rn
  FROM bars
),
flows AS (
  SELECT *,
         lag(tp) OVER (PARTITION BY code ORDER BY date) AS prev_tp,
         CAST(trunc(tp * volume::DOUBLE) AS BIGINT) AS flow
  FROM tp
),
mf AS (
  SELECT *,
         CASE WHEN rn = 1 THEN 0 WHEN prev_tp < tp THEN flow ELSE 0 END::BIGINT AS pmf,
         CASE WHEN rn = 1 THEN 0 WHEN prev_tp < tp THEN 0 ELSE flow END::BIGINT AS nmf
  FROM flows
),
mfr AS (
  SELECT *,
         CASE WHEN count(pmf) OVER f10 = 10 THEN sum(pmf::DOUBLE) OVER f10 END AS psum,
         CASE WHEN count(nmf) OVER f10 = 10 THEN sum(nmf::DOUBLE) OVER f10 END AS nsum
  FROM mf
  WINDOW f10 AS (PARTITION BY code ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
),
mfi AS (
  SELECT *, CASE WHEN nsum = 0 THEN (CASE WHEN psum > 0 THEN 100.0 END)
                 ELSE 100.0 - 100.0 / (1.0 + psum / nsum) END AS mfi10
  FROM mfr
)"""

ORACLE["money_flow"] = f"""
WITH {bars_cte()}, {FLOWS}
SELECT code, date, pmf, nmf FROM mf
"""

ORACLE["mfi10"] = f"""
WITH {bars_cte()}, {FLOWS}
SELECT code, date, {_r('mfi10')} AS mfi10 FROM mfi
"""

II = """
ii AS (
  SELECT *, (2.0 * close::DOUBLE - high::DOUBLE - low::DOUBLE)
              / nullif(high::DOUBLE - low::DOUBLE, 0) * volume::DOUBLE AS ii
  FROM {src}
),
iip AS (
  SELECT *,
         CASE WHEN count(ii) OVER f21 = 21 AND count(volume) OVER f21 = 21
              THEN sum(ii) OVER f21 / nullif(sum(volume::DOUBLE) OVER f21, 0) * 100.0 END AS iip21
  FROM ii
  WINDOW f21 AS (PARTITION BY code ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)
)"""

ORACLE["intraday_intensity"] = f"""
WITH {bars_cte()}, {II.format(src='bars')}
SELECT code, date, {_r('ii', PRICE_PLACES)} AS ii FROM ii
"""

ORACLE["iip21"] = f"""
WITH {bars_cte()}, {II.format(src='bars')}
SELECT code, date, {_r('iip21')} AS iip21 FROM iip
"""

ORACLE["trend_following"] = f"""
WITH {bars_cte()}, {BANDS}, {FLOWS}
SELECT b.code, b.date, b.close, {_r('b.pb')} AS pb, {_r('m.mfi10')} AS mfi10,
       CASE WHEN b.pb > 0.8 AND m.mfi10 > 80 THEN 'buy'
            WHEN b.pb < 0.2 AND m.mfi10 < 20 THEN 'sell' END AS signal
FROM bands2 b JOIN mfi m USING (code, date)
WHERE b.rn > 19
  AND ((b.pb > 0.8 AND m.mfi10 > 80) OR (b.pb < 0.2 AND m.mfi10 < 20))
"""

ORACLE["reversal"] = f"""
WITH {bars_cte()}, {BANDS}, {II.format(src='bands2')},
kept AS (
  SELECT * FROM iip
  WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
    AND volume IS NOT NULL AND center IS NOT NULL AND stddev IS NOT NULL AND upper IS NOT NULL
    AND lower IS NOT NULL AND pb IS NOT NULL AND ii IS NOT NULL AND iip21 IS NOT NULL
)
SELECT code, date, close, {_r('pb')} AS pb, {_r('iip21')} AS iip21,
       CASE WHEN pb < 0.05 AND iip21 > 0 THEN 'buy' WHEN pb > 0.95 AND iip21 < 0 THEN 'sell' END AS signal
FROM kept
WHERE (pb < 0.05 AND iip21 > 0) OR (pb > 0.95 AND iip21 < 0)
"""

# EWM by the textbook recursion: num_t = x_t + q num_{t-1}, den_t = 1 + q den_{t-1}
Q60, Q130, Q45 = "(1.0 - 2.0 / 61.0)", "(1.0 - 2.0 / 131.0)", "(1.0 - 2.0 / 46.0)"
EWM = f"""
seqd AS (
  SELECT code, date, open, high, low, close, volume,
         row_number() OVER (PARTITION BY code ORDER BY date) AS rn
  FROM bars
),
ewm(code, rn, n60, d60, n130, d130, sn, sd) AS (
  SELECT code, rn, close::DOUBLE, 1.0::DOUBLE, close::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE
  FROM seqd WHERE rn = 1
  UNION ALL
  SELECT s.code, s.rn,
         s.close + {Q60} * e.n60, 1.0 + {Q60} * e.d60,
         s.close + {Q130} * e.n130, 1.0 + {Q130} * e.d130,
         ((s.close + {Q60} * e.n60) / (1.0 + {Q60} * e.d60)
          - (s.close + {Q130} * e.n130) / (1.0 + {Q130} * e.d130)) + {Q45} * e.sn,
         1.0 + {Q45} * e.sd
  FROM ewm e JOIN seqd s ON s.code = e.code AND s.rn = e.rn + 1
),
screen1 AS (
  SELECT s.code, s.date, s.open, s.high, s.low, s.close, s.volume,
         e.n60 / e.d60 AS ema60, e.n130 / e.d130 AS ema130,
         e.n60 / e.d60 - e.n130 / e.d130 AS macd, e.sn / e.sd AS signal,
         (e.n60 / e.d60 - e.n130 / e.d130) - e.sn / e.sd AS macdhist
  FROM seqd s JOIN ewm e USING (code, rn)
  WHERE s.open IS NOT NULL AND s.high IS NOT NULL AND s.low IS NOT NULL
    AND s.close IS NOT NULL AND s.volume IS NOT NULL
)"""

STOCH = """
st AS (
  SELECT *,
         max(high::DOUBLE) OVER f14 AS ndays_high,
         min(low::DOUBLE) OVER f14 AS ndays_low,
         (close::DOUBLE - min(low::DOUBLE) OVER f14)
           / nullif(max(high::DOUBLE) OVER f14 - min(low::DOUBLE) OVER f14, 0) * 100.0 AS fast_k
  FROM {src}
  WINDOW f14 AS (PARTITION BY code ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
),
sd AS (
  SELECT *,
         CASE WHEN count(fast_k) OVER f3 = 3 THEN avg(fast_k) OVER f3 END AS slow_d
  FROM st
  WINDOW f3 AS (PARTITION BY code ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)"""


def _e(col: str) -> str:
    return f"round({col}, {EWM_PLACES}) AS {col}"


ORACLE["ewm60"] = f"""
WITH RECURSIVE {bars_cte()}, {EWM}
SELECT code, date, {_e('ema60')} FROM screen1
"""

ORACLE["macd"] = f"""
WITH RECURSIVE {bars_cte()}, {EWM}
SELECT code, date, {_e('ema60')}, {_e('ema130')}, {_e('macd')}, {_e('signal')}, {_e('macdhist')}
FROM screen1
"""

ORACLE["stochastic"] = f"""
WITH {bars_cte()}, {STOCH.format(src='bars')}
SELECT code, date, {_r('ndays_high')} AS ndays_high, {_r('ndays_low')} AS ndays_low,
       {_r('fast_k')} AS fast_k, {_r('slow_d')} AS slow_d
FROM sd
"""

ORACLE["first_screen"] = f"""
WITH RECURSIVE {bars_cte()}, {EWM}
SELECT code, date, open, high, low, close,
       {_e('ema60')}, {_e('ema130')}, {_e('macd')}, {_e('signal')}, {_e('macdhist')}
FROM screen1
"""

SCREEN2 = f"""{STOCH.format(src='screen1')},
screen2 AS (SELECT * FROM sd WHERE fast_k IS NOT NULL AND slow_d IS NOT NULL)"""

ORACLE["second_screen"] = f"""
WITH RECURSIVE {bars_cte()}, {EWM}, {SCREEN2}
SELECT code, date, close, {_e('ema130')}, {_r('ndays_high')} AS ndays_high,
       {_r('ndays_low')} AS ndays_low, {_r('fast_k')} AS fast_k, {_r('slow_d')} AS slow_d
FROM screen2
"""

ORACLE["triple_screen"] = f"""
WITH RECURSIVE {bars_cte()}, {EWM}, {SCREEN2},
lagged AS (
  SELECT *, lag(ema130) OVER w AS pe, lag(slow_d) OVER w AS ps
  FROM screen2 WINDOW w AS (PARTITION BY code ORDER BY date)
),
trades AS (
  SELECT *, CASE WHEN pe < ema130 AND ps >= 20 AND slow_d < 20 THEN 'buy'
                 WHEN pe > ema130 AND ps <= 80 AND slow_d > 80 THEN 'sell' END AS trade
  FROM lagged
)
SELECT code, date, close, {_e('ema130')}, {_r('slow_d')} AS slow_d, trade
FROM trades WHERE trade IS NOT NULL
"""

# --- security master ------------------------------------------------------------
ITEMS_CTE = """
items AS (
  SELECT p_brand AS code,
         CASE WHEN CAST(regexp_extract(p_brand, '#(\\d+)$', 1) AS INTEGER) % 2 = 1 THEN 'Y' ELSE 'N' END AS status,
         'CO BRAND#' || CAST(least(CAST(regexp_extract(p_brand, '#(\\d+)$', 1) AS INTEGER), 24) AS VARCHAR) AS name
  FROM part GROUP BY p_brand
)"""

ORACLE["price_scan"] = f"""
WITH {bars_cte()}, {ITEMS_CTE},
tok(token) AS (VALUES ('CO BRAND#24'), ('Brand#3'), ('CO BRAND#7'), ('NO SUCH CO')),
res AS (
  SELECT token, coalesce((SELECT i.code FROM items i WHERE i.code = token),
                         (SELECT min(i.code) FROM items i WHERE i.name = token)) AS code
  FROM tok
)
SELECT code, date, ymd, open, high, low, close, volume
FROM bars WHERE code IN (SELECT code FROM res) AND ymd BETWEEN '19960101' AND '19981231'
"""

ORACLE["price_history"] = f"""
WITH {bars_cte()}
SELECT code, date, ymd, open, high, low, close, volume FROM bars ORDER BY code, date
"""

ORACLE["resolve_tokens"] = f"""
WITH {ITEMS_CTE},
tok AS (SELECT name AS token FROM items UNION SELECT code FROM items UNION SELECT lower(name) FROM items)
SELECT token, coalesce((SELECT i.code FROM items i WHERE i.code = token),
                       (SELECT min(i.code) FROM items i WHERE i.name = token)) AS code
FROM tok
"""

ORACLE["active_universe"] = f"""
WITH {ITEMS_CTE}
SELECT code, name FROM items WHERE status = 'Y'
"""

# --- momentum -------------------------------------------------------------------
ORACLE["asof_day"] = f"""
WITH {bars_cte()},
req AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS requested FROM orders),
days AS (SELECT DISTINCT date FROM bars)
SELECT requested, trading_day FROM (
  SELECT requested, (SELECT max(date) FROM days WHERE date <= requested) AS trading_day FROM req)
WHERE trading_day IS NOT NULL
"""

MOMENTUM = """
d AS (SELECT (SELECT max(date) FROM bars WHERE date <= DATE '{s}') AS d0,
             (SELECT max(date) FROM bars WHERE date <= DATE '{e}') AS d1),
p AS (
  SELECT code,
         max(CASE WHEN date = (SELECT d0 FROM d) THEN close END) AS old_price,
         max(CASE WHEN date = (SELECT d1 FROM d) THEN close END) AS new_price
  FROM bars GROUP BY code
  HAVING max(CASE WHEN date = (SELECT d0 FROM d) THEN close END) IS NOT NULL
     AND max(CASE WHEN date = (SELECT d1 FROM d) THEN close END) IS NOT NULL
),
{name} AS (
  SELECT p.code, i.name AS company, old_price, new_price,
         (new_price::DOUBLE / nullif(old_price::DOUBLE, 0) - 1.0) * 100.0 AS returns
  FROM p JOIN items i USING (code)
)"""

RLTV_CTE = MOMENTUM.format(s="1996-01-03", e="1998-12-31", name="m1") + """,
top AS (
  SELECT *, row_number() OVER (ORDER BY returns DESC, code ASC) AS rank FROM m1
  ORDER BY returns DESC, code ASC LIMIT 10
)"""

ABS_CTE = RLTV_CTE.replace("\nd AS", "\nd1x AS", 0) + "," + MOMENTUM.format(
    s="1999-01-04", e="1999-12-31", name="m2").replace("d AS (", "dd AS (").replace(
    "FROM d)", "FROM dd)").replace("\np AS (", "\npp AS (").replace("FROM p JOIN", "FROM pp p JOIN") + """,
absm AS (SELECT * FROM m2 WHERE code IN (SELECT code FROM top))"""

ORACLE["two_date_prices"] = f"""
WITH {bars_cte('day')}, {MOMENTUM.format(s='1996-01-03', e='1998-12-31', name='unused')}
SELECT code, old_price, new_price FROM p
"""

ORACLE["relative_momentum"] = f"""
WITH {bars_cte('day')}, {ITEMS_CTE}, {RLTV_CTE}
SELECT code, company, old_price, new_price, {_r('returns')} AS returns, rank FROM top
"""

ORACLE["absolute_momentum"] = f"""
WITH {bars_cte('day')}, {ITEMS_CTE}, {ABS_CTE}
SELECT code, company, old_price, new_price, {_r('returns')} AS returns FROM absm
"""

ORACLE["momentum_summary"] = f"""
WITH {bars_cte('day')}, {ITEMS_CTE}, {ABS_CTE}
SELECT count(*) AS n_codes, {_r('avg(returns)')} AS mean_returns FROM absm
"""

# --- portfolio ------------------------------------------------------------------
RETS_CTE = """
idx AS (
  SELECT date, row_number() OVER (ORDER BY date) - 1 AS k
  FROM bars WHERE code = (SELECT min(code) FROM items)
),
present AS (
  SELECT b.code, i.k, i.date, b.close
  FROM bars b JOIN idx i USING (date) WHERE b.code IN (SELECT code FROM items)
),
k0 AS (SELECT code, min(k) AS k0 FROM present GROUP BY code),
grid AS (SELECT k0.code, i.k, i.date FROM k0 JOIN idx i ON i.k >= k0.k0),
g AS (SELECT grid.code, grid.k, grid.date, p.close FROM grid LEFT JOIN present p USING (code, k)),
ff AS (
  SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY code ORDER BY k
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ffc
  FROM g
),
rets AS (
  SELECT code, k, date,
         ffc::DOUBLE / nullif(lag(ffc) OVER (PARTITION BY code ORDER BY k)::DOUBLE, 0) - 1.0 AS ret
  FROM ff
),
annual AS (SELECT code, avg(ret) * 252.0 AS annual_ret FROM rets GROUP BY code),
covm AS (
  SELECT a.code AS code_i, b.code AS code_j, covar_samp(a.ret, b.ret) * 252.0 AS cov
  FROM rets a JOIN rets b USING (k)
  WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL
  GROUP BY 1, 2
)"""

WEIGHTS_CTE = """
u AS (SELECT list(code ORDER BY code) AS codes FROM items),
raw AS (
  SELECT r.range AS portfolio_id, u.codes,
         list_transform(u.codes, lambda c: ('0x' || substr(md5(CAST(r.range AS VARCHAR) || '-' || c), 1, 8))::BIGINT
                                      / 4294967296.0) AS uu
  FROM range(20000) r, u
),
wts AS (
  SELECT portfolio_id, codes, list_transform(uu, lambda x: x / list_reduce(uu, lambda a, b: a + b)) AS weights
  FROM raw
),
wl AS (
  SELECT portfolio_id, unnest(codes) AS code, unnest(weights) AS w FROM wts
),
scores AS (
  SELECT r.portfolio_id, r.returns, k.risk, r.returns / nullif(k.risk, 0) AS sharpe
  FROM (SELECT portfolio_id, sum(w * annual_ret) AS returns
        FROM wl JOIN annual USING (code) GROUP BY 1) r
  JOIN (SELECT a.portfolio_id, sqrt(sum(a.w * b.w * c.cov)) AS risk
        FROM wl a JOIN wl b USING (portfolio_id)
        JOIN covm c ON c.code_i = a.code AND c.code_j = b.code GROUP BY 1) k
  USING (portfolio_id)
)"""

ORACLE["daily_returns"] = f"""
WITH {bars_cte()}, {ITEMS_CTE}, {RETS_CTE}
SELECT code, date, round(ret, 10) AS ret FROM rets
"""

ORACLE["annual_return"] = f"""
WITH {bars_cte()}, {ITEMS_CTE}, {RETS_CTE}
SELECT code, {_r('annual_ret')} AS annual_ret FROM annual
"""

ORACLE["covariance"] = f"""
WITH {bars_cte()}, {ITEMS_CTE}, {RETS_CTE}
SELECT code_i, code_j, {_r('cov')} AS cov FROM covm
"""

ORACLE["candidate_weights"] = f"""
WITH {ITEMS_CTE}, {WEIGHTS_CTE}
SELECT portfolio_id, code, round(w, 10) AS weight FROM wl
"""

ORACLE["portfolio_scores"] = f"""
WITH {bars_cte()}, {ITEMS_CTE}, {RETS_CTE}, {WEIGHTS_CTE}
SELECT portfolio_id, {_r('returns')} AS returns, {_r('risk')} AS risk, {_r('sharpe')} AS sharpe FROM scores
"""

ORACLE["portfolio_best"] = f"""
WITH {bars_cte()}, {ITEMS_CTE}, {RETS_CTE}, {WEIGHTS_CTE}
SELECT portfolio_id, {_r('returns')} AS returns, {_r('risk')} AS risk, {_r('sharpe')} AS sharpe,
       'max_sharpe' AS kind
FROM scores WHERE sharpe = (SELECT max(sharpe) FROM scores)
UNION ALL
SELECT portfolio_id, {_r('returns')} AS returns, {_r('risk')} AS risk, {_r('sharpe')} AS sharpe,
       'min_risk' AS kind
FROM scores WHERE risk = (SELECT min(risk) FROM scores)
"""

# --- upserts and ingest ---------------------------------------------------------------

CUT = "DATE '1999-01-04'"
OLD_TS = "TIMESTAMP '2020-01-01 00:00:00'"
RUN_TS = "TIMESTAMP '2021-02-01 17:00:00'"


def _ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S') AS {col}"


PAIR = f"""
cur AS (SELECT code, date, ymd, open, high, low, close, diff, volume FROM bars WHERE date < {CUT}),
batch AS (
  SELECT code, date, ymd, open, high, low, close + 1 AS close, diff, volume, 1 AS seq
  FROM bars WHERE date >= {CUT} - 28
  UNION ALL
  SELECT code, date, ymd, open, high, low, close + 2 AS close, diff, volume, 2 AS seq
  FROM bars WHERE date = {CUT}
),
bb AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY code, date ORDER BY seq DESC) AS rn FROM batch)
  WHERE rn = 1
)"""

ORACLE["upsert_replace"] = f"""
WITH {bars_cte()}, {PAIR},
u AS (SELECT code, date, open, high, low, close, volume, -1 AS seq FROM cur
      UNION ALL SELECT code, date, open, high, low, close, volume, seq FROM batch)
SELECT code, date, open, high, low, close, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY code, date ORDER BY seq DESC) AS rn FROM u)
WHERE rn = 1
"""


MERGE_BARS_SELECT = f"""
SELECT coalesce(c.code, b.code) AS code, coalesce(c.date, b.date) AS date,
       CASE WHEN b.code IS NOT NULL THEN b.open ELSE c.open END AS open,
       CASE WHEN b.code IS NOT NULL THEN b.high ELSE c.high END AS high,
       CASE WHEN b.code IS NOT NULL THEN b.low ELSE c.low END AS low,
       CASE WHEN b.code IS NOT NULL THEN b.close ELSE c.close END AS close,
       CASE WHEN b.code IS NOT NULL THEN b.volume ELSE c.volume END AS volume,
       strftime(CASE WHEN c.code IS NOT NULL THEN {OLD_TS} ELSE {RUN_TS} END, '%Y-%m-%d %H:%M:%S') AS reg_dt,
       strftime(CASE WHEN b.code IS NOT NULL THEN {RUN_TS} ELSE {OLD_TS} END, '%Y-%m-%d %H:%M:%S') AS upd_dt
FROM cur c FULL OUTER JOIN bb b ON c.code = b.code AND c.date = b.date
"""

ORACLE["merge_bars"] = f"""
WITH {bars_cte()}, {PAIR}
{MERGE_BARS_SELECT}
"""

ORACLE["stream_upsert"] = ORACLE["merge_bars_by_year"] = ORACLE["merge_bars"]
ORACLE["upsert_bucketed"] = ORACLE["upsert_replace"]

ORACLE["ingest_filtered"] = f"""
WITH {bars_cte()}, {ITEMS_CTE},
cur AS (SELECT * FROM bars WHERE date < {CUT}),
bb AS (
  SELECT code, date, open, high, low, close + 1 AS close, volume FROM bars
  WHERE date >= DATE '1998-12-07' AND code IN (SELECT code FROM items WHERE status = 'Y')
)
{MERGE_BARS_SELECT}
"""

ORACLE["ingest_chain"] = f"""
WITH {bars_cte()},
l AS (SELECT DISTINCT CAST(regexp_extract(p_brand, '#([0-9]+)$', 1) AS INTEGER) AS n FROM part),
b AS (SELECT printf('%06d', CAST(regexp_extract(code, '#([0-9]+)$', 1) AS INTEGER)) AS code, CAST(regexp_extract(code, '#([0-9]+)$', 1) AS INTEGER) AS n,
             ymd, date, open, high, low, close, volume FROM bars),
c AS (SELECT * FROM b WHERE date < {CUT}),
s AS (SELECT * REPLACE (close + 1 AS close) FROM b WHERE date >= DATE '1998-12-07' AND n BETWEEN 10 AND 20),
rows_ AS (
  SELECT 'item' AS kind, printf('%06d', n) AS code, CASE WHEN n >= 10 THEN 'COMPANY ' ELSE 'Company ' END || n AS name,
         CASE WHEN n >= 10 THEN '20210201' ELSE '20210101' END AS ymd, CAST(NULL AS VARCHAR) AS bar,
         CASE WHEN n <= 15 THEN {OLD_TS} ELSE {RUN_TS} END AS reg_dt, CASE WHEN n BETWEEN 10 AND 15 THEN {RUN_TS} END AS upd_dt
  FROM l WHERE n <= 20
  UNION ALL
  SELECT 'bar', coalesce(c.code, s.code), NULL, coalesce(c.ymd, s.ymd),
         concat_ws(' ', coalesce(s.open, c.open), coalesce(s.high, c.high), coalesce(s.low, c.low), coalesce(s.close, c.close), coalesce(s.volume, c.volume)),
         CASE WHEN c.code IS NULL THEN {RUN_TS} ELSE {OLD_TS} END, CASE WHEN s.code IS NULL THEN {OLD_TS} ELSE {RUN_TS} END
  FROM c FULL OUTER JOIN s ON c.code = s.code AND c.date = s.date)
SELECT kind, code, name, ymd, bar, {_ts('reg_dt')}, {_ts('upd_dt')} FROM rows_
"""

ORACLE["create_tables"] = "SELECT printf('%06d', p_partkey) AS code, p_name AS company, DATE '2021-02-01' AS last_update FROM part"

LISTING = """
listing AS (
  SELECT printf('%06d', p_partkey) AS code, p_name AS name, p_type AS sector, p_brand AS products,
         CAST(NULL AS VARCHAR) AS listing_day, CAST(p_size AS VARCHAR) AS fiscal_month,
         CAST(NULL AS VARCHAR) AS ceo, CAST(NULL AS VARCHAR) AS homepage, CAST(NULL AS VARCHAR) AS region,
         p_size AS size
  FROM part
)"""

ORACLE["listing_clean"] = f"""
WITH {LISTING}
SELECT code, name, sector, products, listing_day, fiscal_month, ceo, homepage, region FROM listing
"""

ITEM_VALS = ["ymd", "status", "name", "sector", "products", "listing_day", "fiscal_month", "ceo",
             "homepage", "region"]

ORACLE["merge_items"] = f"""
WITH {LISTING},
c AS (SELECT code, '20210101' AS ymd, 'Y' AS status, name, sector, products, listing_day, fiscal_month,
             ceo, homepage, region FROM listing WHERE size <= 25),
b AS (SELECT code, '20210201' AS ymd, 'Y' AS status, upper(name) AS name, sector, products, listing_day,
             fiscal_month, ceo, homepage, region FROM listing WHERE size >= 20)
SELECT coalesce(c.code, b.code) AS code,
       {", ".join(f"CASE WHEN b.code IS NOT NULL THEN b.{x} ELSE c.{x} END AS {x}" for x in ITEM_VALS)},
       strftime(CASE WHEN c.code IS NOT NULL THEN {OLD_TS} ELSE {RUN_TS} END, '%Y-%m-%d %H:%M:%S') AS reg_dt,
       strftime(CASE WHEN c.code IS NOT NULL AND b.code IS NOT NULL THEN {RUN_TS} END, '%Y-%m-%d %H:%M:%S')
         AS upd_dt
FROM c FULL OUTER JOIN b ON c.code = b.code
"""

ORACLE["needs_refresh"] = """
SELECT max(CAST(DATE '2021-01-01' + p_size AS DATE)) AS last_update,
       (max(CAST(DATE '2021-01-01' + p_size AS DATE)) IS NULL
        OR max(CAST(DATE '2021-01-01' + p_size AS DATE)) < DATE '2021-03-01') AS needs_refresh
FROM part
"""

ORACLE["company_info_replace"] = """
WITH c AS (SELECT printf('%06d', p_partkey) AS code, p_name AS company,
                  CAST(DATE '2021-01-01' + p_size AS DATE) AS last_update FROM part WHERE p_size <= 25),
b AS (SELECT printf('%06d', p_partkey) AS code, p_name AS company, DATE '2021-02-01' AS last_update FROM part)
SELECT coalesce(b.code, c.code) AS code,
       CASE WHEN b.code IS NOT NULL THEN b.company ELSE c.company END AS company,
       CASE WHEN b.code IS NOT NULL THEN b.last_update ELSE c.last_update END AS last_update
FROM c FULL OUTER JOIN b ON c.code = b.code
"""

CLEAN = "(CASE WHEN t LIKE '%N%' THEN 0.0 ELSE TRY_CAST(replace(t, ',', '') AS DOUBLE) END)"

ORACLE["measure_clean"] = f"""
WITH m AS (
  SELECT c_custkey AS key,
         CASE WHEN c_custkey % 10 = 0 THEN 'N/A' WHEN c_custkey % 10 = 1 THEN ''
              ELSE format('{{:,.2f}}', c_acctbal) END AS text
  FROM customer
)
SELECT key, text, {CLEAN.replace('t', "(CASE WHEN text = '' THEN '0' ELSE text END)")} AS value FROM m
"""

HDR = ", ".join(f"({i + 1}, '{h}', '{m}')" for i, (h, m) in enumerate(zip(MEASURE_HEADERS, MEASURES)))

CLEAN_TEXT = CLEAN.replace('t', "(CASE WHEN c.text = '' THEN '0' ELSE c.text END)")

CELLS = f"""
hdr(i, h, m) AS (VALUES {HDR}),
t AS (
  SELECT p_brand AS code, l_shipdate, l_quantity, hdr.h,
         CASE WHEN year(l_shipdate) >= 2001 OR (year(l_shipdate) = 1998 AND l_suppkey % 3 = 0) THEN 1 ELSE 0 END AS e
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN hdr ON hdr.i = (l_linenumber - 1) * 4 + l_partkey % 4 + 1),
raw AS (
  SELECT code, 'Q' AS gb,
         CAST(year(l_shipdate) AS VARCHAR) || '/' || lpad(CAST(quarter(l_shipdate) * 3 AS VARCHAR), 2, '0')
           || CASE e WHEN 1 THEN '(E)' ELSE '' END AS period_header,
         CAST((year(l_shipdate) * 100 + quarter(l_shipdate) * 3) * 2 + e AS INTEGER) AS pos, h AS measure, l_quantity
  FROM t
  UNION ALL
  SELECT code, 'Y' AS gb,
         CAST(year(l_shipdate) AS VARCHAR) || '/12' || CASE e WHEN 1 THEN '(E)' ELSE '' END AS period_header,
         CAST((year(l_shipdate) * 100 + 12) * 2 + e AS INTEGER) AS pos, chr(160) || h AS measure, l_quantity
  FROM t
),
cells AS (
  SELECT code, gb, period_header, pos, measure,
         format('{{:,}}', CAST(sum(l_quantity) AS BIGINT)) || CASE WHEN CAST(sum(l_quantity) AS BIGINT) % 100 = 13 THEN 'x' ELSE '' END AS text
  FROM raw GROUP BY code, gb, period_header, pos, measure
)"""


def _statements(cells: str) -> str:
    """Rows of the statements in ``cells``: of two columns with one ym, the one further right."""
    return f"""named AS (
  SELECT c.code, c.gb, c.pos, replace(regexp_replace(c.period_header, '[^0-9/]', '', 'g'), '/', '-') AS ym,
         contains(c.period_header, '(E)') AS est, hdr.m, {CLEAN_TEXT} AS v
  FROM {cells} c JOIN hdr ON hdr.h = replace(c.measure, chr(160), '')
),
columns_ AS (
  SELECT code, ym, gb, pos, est, {", ".join(f"any_value(v) FILTER (WHERE m = '{m}') AS {m}" for m in MEASURES)}
  FROM named GROUP BY code, ym, gb, pos, est
),
fund AS (
  SELECT code, ym, gb, est AS is_estimate, {", ".join(MEASURES)}
  FROM columns_ QUALIFY row_number() OVER (PARTITION BY code, ym, gb ORDER BY pos DESC) = 1
)"""


STATEMENTS = f"{CELLS},\n{_statements('cells')}"

ORACLE["fundamentals_pivot"] = f"""
WITH {STATEMENTS}
SELECT * FROM fund
"""

# a rendered page is a full grid: a measure row with no value for a period
# shows an empty cell, which reads as '0' (F8)
ORACLE["statement_pages"] = f"""
WITH {CELLS},
grid AS (
  SELECT p.code, p.gb, p.period_header, p.pos, m.measure
  FROM (SELECT DISTINCT code, gb, period_header, pos FROM cells) p
  JOIN (SELECT DISTINCT code, gb, measure FROM cells) m USING (code, gb)
),
full_cells AS (
  SELECT g.code, g.gb, g.period_header, g.pos, g.measure, coalesce(c.text, '') AS text
  FROM grid g LEFT JOIN cells c USING (code, gb, period_header, pos, measure)
),
{_statements('full_cells')}
SELECT * FROM fund
"""

ORACLE["merge_fundamentals"] = f"""
WITH {STATEMENTS},
c AS (SELECT * FROM fund WHERE ym < '2000'),
b AS (SELECT * REPLACE (SALES + 1 AS SALES) FROM fund WHERE ym >= '1999')
SELECT coalesce(c.code, b.code) AS code, coalesce(c.ym, b.ym) AS ym, coalesce(c.gb, b.gb) AS gb,
       CASE WHEN b.code IS NOT NULL THEN b.is_estimate ELSE c.is_estimate END AS is_estimate,
       {", ".join(f"CASE WHEN b.code IS NOT NULL THEN b.{m} ELSE c.{m} END AS {m}" for m in MEASURES)},
       'sys' AS reg_id, 'sys' AS upd_id,
       strftime(CASE WHEN b.code IS NOT NULL THEN {RUN_TS} ELSE {OLD_TS} END, '%Y-%m-%d %H:%M:%S') AS reg_dt,
       strftime(CASE WHEN b.code IS NOT NULL THEN {RUN_TS} ELSE {OLD_TS} END, '%Y-%m-%d %H:%M:%S') AS upd_dt
FROM c FULL OUTER JOIN b ON c.code = b.code AND c.ym = b.ym AND c.gb = b.gb
"""

QUOTES = """
s AS (
  SELECT code, date, ymd, open, high, low, close, volume,
         coalesce(close - lag(close) OVER (PARTITION BY code ORDER BY date), 0) AS diff,
         row_number() OVER (PARTITION BY code ORDER BY date DESC) - 1 AS rd
  FROM bars
)"""

ORACLE["html_quotes"] = f"""
WITH {bars_cte()}, {QUOTES}
SELECT code, date, ymd, open, high, low, close, diff, volume FROM s
"""

ORACLE["html_quotes_capped"] = f"""
WITH {bars_cte()}, {QUOTES}
SELECT code, date, ymd, open, high, low, close, diff, volume FROM s WHERE rd < 50
"""

# --- remaining inventory items ---------------------------------------------------------
ORACLE["chart_frame"] = f"""
WITH {bars_cte()}, {BANDS}
SELECT code, date, open, high, low, close, volume,
       {_r('center', PRICE_PLACES)} AS center, {_r('upper', PRICE_PLACES)} AS upper,
       {_r('lower', PRICE_PLACES)} AS lower
FROM bands2 WHERE rn > 19
"""

ORACLE["vendor_bars"] = f"""
WITH {bars_cte()}
SELECT code, date, ymd, open, high, low, close, volume, CAST(close AS DOUBLE) * 0.5 AS adj_close
FROM bars WHERE date >= DATE '2000-01-01'
"""

ORACLE["ingest_quotes"] = f"""
WITH {bars_cte()}, {ITEMS_CTE}, {QUOTES},
b AS (SELECT * FROM s WHERE code IN (SELECT code FROM items WHERE status = 'Y')),
cur AS (SELECT * FROM bars WHERE date < {CUT})
SELECT code, date, open, high, low, close, volume, CAST(diff AS VARCHAR) AS diff FROM b
UNION ALL
SELECT code, date, open, high, low, close, volume, CAST(NULL AS VARCHAR) AS diff FROM cur ANTI JOIN b USING (code, date)
"""

READABLE = f"""good AS (
  SELECT c.* FROM cells c JOIN hdr ON hdr.h = replace(c.measure, chr(160), '') WHERE {CLEAN_TEXT} IS NOT NULL
)"""

ORACLE["ingest_fundamentals"] = f"""
WITH {ITEMS_CTE}, {CELLS}, {READABLE}, {_statements('good')}
SELECT * FROM fund WHERE code IN (SELECT code FROM items WHERE status = 'Y')
"""

ORACLE["fundamentals_quarantine"] = f"""
WITH {ITEMS_CTE}, {CELLS}, {READABLE}
SELECT code, gb, period_header, pos, measure, text FROM cells ANTI JOIN good USING (code, gb, period_header, pos, measure)
WHERE code IN (SELECT code FROM items WHERE status = 'Y')
"""

ORACLE["read_items"] = f"WITH {ITEMS_CTE} SELECT code, name FROM items"

ORACLE["read_company_info"] = "SELECT printf('%06d', p_partkey) AS code, p_name AS company FROM part"

ORACLE["price_raw"] = f"""
WITH {bars_cte()}
SELECT code, date, ymd, open, high, low, close, volume FROM bars
WHERE code = 'Brand#3' AND ymd BETWEEN '19960101' AND '19981231'
"""

ORACLE["price_last_year"] = f"""
WITH {bars_cte()}, {ITEMS_CTE}
SELECT code, date, ymd, open, high, low, close, volume FROM bars
WHERE date BETWEEN DATE '1998-12-31' - 365 AND DATE '1998-12-31' AND code IN (SELECT code FROM items WHERE status = 'Y')
"""

ORACLE["listing_simple"] = f"WITH {LISTING} SELECT code, name FROM listing"

ORACLE["ymd_dates"] = f"WITH {bars_cte()} SELECT code, ymd, CAST(strptime(ymd, '%Y%m%d') AS DATE) AS parsed FROM bars"

ORACLE["company_info_refresh"] = ORACLE["company_info_replace"]

ORACLE["percent_b_scaled"] = f"""
WITH {bars_cte()}, {BANDS}
SELECT code, date, {_r('pb * 100')} AS pb_percent FROM bands2 WHERE rn > 19
"""


def _ewm_sum(span: int) -> str:
    """The definition: weights fall by q a row; sums run over all earlier rows with a close."""
    q = f"(1.0 - 2.0 / ({span} + 1.0))"
    return (f"(SELECT sum(power({q}, a.rn - b.rn) * b.close) / sum(power({q}, a.rn - b.rn)) FROM g b "
            f"WHERE b.code = a.code AND b.rn <= a.rn AND b.rn > a.last_rn - 2000 AND b.close IS NOT NULL)")


# where the weights of all earlier closes have vanished, the mean is that of the last close's row
ORACLE["ewm_gaps"] = f"""
WITH {bars_cte()},
g AS (SELECT code, date, CASE WHEN volume % 3 <> 0 THEN CAST(close AS DOUBLE) END AS close,
             row_number() OVER (PARTITION BY code ORDER BY date) AS rn FROM bars),
a AS (SELECT *, max(CASE WHEN close IS NOT NULL THEN rn END) OVER (PARTITION BY code ORDER BY rn) AS last_rn,
             last_value(close IGNORE NULLS) OVER (PARTITION BY code ORDER BY rn) AS last_close FROM g)
SELECT code, date, round(last_close, {EWM_PLACES}) AS ema1,
       round({_ewm_sum(2)}, {EWM_PLACES}) AS ema2, round({_ewm_sum(60)}, {EWM_PLACES}) AS ema60
FROM a
"""
