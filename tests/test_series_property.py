"""Property test: series windows equal whole-series pandas for random
series, NULL patterns, spans and frames."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import bars_frame, series_rows
from tickweave.functions import series as S


@st.composite
def cases(draw):
    n_a = draw(st.integers(1, 90))
    n_b = draw(st.integers(1, 40))
    span = draw(st.sampled_from([1, 2, 9, 130]))
    halo = draw(st.integers(0, 6))
    seed = draw(st.integers(0, 10_000))
    null_rate = draw(st.sampled_from([0.0, 0.1, 0.4]))
    return n_a, n_b, span, halo, seed, null_rate


def _closes(n, rng, null_rate):
    vals = np.round(500 + np.cumsum(rng.normal(0, 10, n))).astype(int)
    return [None if rng.random() < null_rate else int(v) for v in vals]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(c=cases())
def test_series_equals_pandas(spark, c):
    n_a, n_b, span, halo, seed, null_rate = c
    rng = np.random.default_rng(seed)
    rows = series_rows("A", _closes(n_a, rng, null_rate)) + series_rows("B", _closes(n_b, rng, null_rate))
    df = bars_frame(spark, rows)
    s = S.open_series(df)
    s = S.ewm_mean(s, "close", span, "e")
    s = S.forward_fill(s, "close", "ff")
    w = halo + 1
    s = (s.withColumn("m", S.rolling(F.col("close").cast("double"), w, F.avg))
          .withColumn("p", S.lag("close")) if halo >= 1 else s.withColumn("m", F.col("close").cast("double"))
          .withColumn("p", F.lit(None).cast("double")))
    got = S.finish(s).select("code", "date", "close", "e", "ff", "m", "p").toPandas() \
        .sort_values(["code", "date"])
    for code, g in got.groupby("code"):
        c = g["close"].astype(float)
        np.testing.assert_allclose(g["e"].astype(float), c.ewm(span=span).mean(), rtol=1e-9, equal_nan=True)
        np.testing.assert_allclose(g["ff"].astype(float), c.ffill(), equal_nan=True)
        if halo >= 1:
            np.testing.assert_allclose(g["m"].astype(float), c.rolling(w).mean(), rtol=1e-12, equal_nan=True)
            np.testing.assert_allclose(g["p"].astype(float), c.shift(1), equal_nan=True)
    assert isinstance(got, pd.DataFrame)
