"""Window features against pandas on small frames with nulls, gaps and ties."""

import datetime as dt

import math

import numpy as np
import pandas as pd
import pytest

from tessellate.operators.windows import ewm_features, lag_features, rolling_features, target_encoding

from .compare import close_frames


def frame():
    rng = np.random.default_rng(7)
    rows = []
    for k in ["a", "b", "c"]:
        n = {"a": 30, "b": 1, "c": 12}[k]
        for i in range(n):
            v = float(rng.integers(0, 20))
            if (k == "a" and i in (0, 5, 6)) or (k == "c" and i == 3):
                v = None
            rows.append((k, dt.date(2020, 1, 7) + dt.timedelta(days=7 * i), v))
    rows.append((None, dt.date(2020, 1, 7), 3.0))
    return pd.DataFrame(rows, columns=["k", "date", "qty"])


@pytest.fixture(scope="module")
def sdf(spark):
    return spark.createDataFrame(frame(), "k string, date date, qty double")


def pandas_ref(pdf, fn):
    pdf = pdf.sort_values(["k", "date"]).reset_index(drop=True)
    g = pdf.groupby("k")["qty"]
    return pdf, g


def by_definition(pdf, value):
    """``value(series up to the row)`` for each row of each key, null without a key."""
    out = []
    for i in range(len(pdf)):
        row = pdf.iloc[i]
        if row.k is None or row.k != row.k:
            out.append(np.nan)
        else:
            out.append(value(pdf[(pdf.k == row.k) & (pdf.date <= row.date)].sort_values("date").qty.tolist()))
    return out


def window_stat(past, lag, width, stat):
    """Mean or sample deviation of the ``width`` values that end ``lag`` rows ago; null if any is missing."""
    end = len(past) - lag
    values = past[end - width:end] if end >= width else []
    if not values or any(v != v for v in values):
        return np.nan
    mean = math.fsum(values) / width
    if stat == "mean":
        return mean
    return math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (width - 1))


def weighted_mean(past, lag, alpha):
    """Weights (1 - alpha)^age over the values up to ``lag`` rows ago; missing ones age the rest."""
    seen = past[:len(past) - lag]
    weights = [((1 - alpha) ** (len(seen) - 1 - i), v) for i, v in enumerate(seen) if v == v]
    return math.fsum(w * v for w, v in weights) / math.fsum(w for w, _ in weights) if weights else np.nan


def test_lags(sdf):
    out = lag_features(sdf, ["k"], "date", "qty", [1, 3]).toPandas()
    pdf, g = pandas_ref(frame(), None)
    pdf["qty_lag_1"] = g.shift(1)
    pdf["qty_lag_3"] = g.shift(3)
    close_frames(out, pdf, ["k", "date"])


@pytest.mark.parametrize("stat", ["mean", "std"])
def test_rolling(sdf, stat):
    out = rolling_features(sdf, ["k"], "date", "qty", [2, 4], [1, 3], stats=(stat,)).toPandas()
    pdf, g = pandas_ref(frame(), None)
    for l in [1, 3]:
        for w in [2, 4]:
            pdf[f"qty_roll_{stat}_lag_{l}_win_{w}"] = by_definition(pdf, lambda past: window_stat(past, l, w, stat))
    close_frames(out, pdf, ["k", "date"], rtol=1e-9, atol=1e-9)


def test_ewm_nulls(sdf):
    alphas, lags = [0.99, 0.5, 0.1], [0, 2]
    out = ewm_features(sdf, ["k"], "date", "qty", alphas, lags).toPandas()
    pdf, g = pandas_ref(frame(), None)
    for l in lags:
        for a in alphas:
            pdf[f"qty_ewm_lag_{l}_alpha_{str(a).replace('.', '')}"] = by_definition(
                pdf, lambda past: weighted_mean(past, l, a))
    close_frames(out[pdf.columns], pdf, ["k", "date"], rtol=1e-12, atol=1e-12)


def test_target_encoding(sdf):
    out = target_encoding(sdf, "qty", [["k"]]).toPandas()
    pdf = frame()
    pdf["enc_k_mean"] = pdf.groupby("k")["qty"].transform("mean")
    pdf["enc_k_std"] = pdf.groupby("k")["qty"].transform("std")
    close_frames(out, pdf, ["k", "date"])


def test_target_encoding_as_of_uses_only_earlier_rows(sdf):
    out = target_encoding(sdf, "qty", [["k"]], as_of="date").toPandas()
    pdf = frame().sort_values(["k", "date"]).reset_index(drop=True)
    means, stds = [], []
    for _, r in pdf.iterrows():
        prev = pdf[(pdf.k == r.k) & (pdf.date < r.date)]["qty"] if r.k is not None else pd.Series([], dtype=float)
        means.append(prev.mean() if prev.notna().any() else np.nan)
        stds.append(prev.std() if prev.notna().sum() > 1 else np.nan)
    pdf["enc_k_mean"], pdf["enc_k_std"] = means, stds
    close_frames(out, pdf, ["k", "date"])


def test_ewm_keys_spanning_arrow_batches(spark, sdf):
    """Tiny Arrow batches force keys to straddle batches (carry-over path)."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        out = ewm_features(sdf.repartition(1), ["k"], "date", "qty", [0.5], [1]).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    pdf, g = pandas_ref(frame(), None)
    pdf["qty_ewm_lag_1_alpha_05"] = by_definition(pdf, lambda past: weighted_mean(past, 1, 0.5))
    close_frames(out[pdf.columns], pdf, ["k", "date"], rtol=1e-12, atol=1e-12)
