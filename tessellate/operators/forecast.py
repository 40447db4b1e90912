"""Per-partition forecasting from aggregated sufficient statistics.

A least-squares fit needs only the count, the means and the centred
cross-products of a group. Tasks compute them for their batches and merge them,
so one huge partition never has to sit in a single task; a group's few block
sums are merged and solved together; predictions are a join of the
coefficient table plus a dot product in the JVM.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import as_list
from ..session import stored
from .boosting import thresholds
from .reshape import union_by_name


class _Sums:
    """Count, means and centred cross-products of [features, target] of one group."""

    def __init__(self, n: float, mean: np.ndarray, cross: np.ndarray):
        self.n, self.mean, self.cross = n, mean, cross

    @classmethod
    def of(cls, x: np.ndarray) -> "_Sums":
        mean = x.mean(axis=0)
        centred = x - mean
        return cls(float(len(x)), mean, centred.T @ centred)

    def merge(self, other: "_Sums") -> "_Sums":
        n = self.n + other.n
        d = other.mean - self.mean
        return _Sums(n, self.mean + d * (other.n / n),
                     self.cross + other.cross + np.outer(d, d) * (self.n * other.n / n))


def block_sums(df: DataFrame, group_cols, features, target: str, held: int = 2_000) -> DataFrame:
    """``group..., n, mean, cross`` of the rows without nulls: one row per group and
    task (more where a task sees over ``held`` groups), whatever the rows.

    Centred in each Arrow batch and merged by means, so no digits are lost to
    large values, and as wide as the features allow: a batch is one matrix
    product, not an aggregate for every pair of features.
    """
    g, cols = as_list(group_cols), [*as_list(features), target]
    present = df.select(*g, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    keys = [f for f in present.schema.fields if f.name in g]
    schema = T.StructType(keys + [T.StructField("n", T.DoubleType()), T.StructField("mean", T.ArrayType(T.DoubleType())),
                                  T.StructField("cross", T.ArrayType(T.DoubleType()))])

    def rows(sums: dict) -> pd.DataFrame:
        out = pd.DataFrame(list(sums), columns=g) if g else pd.DataFrame(index=range(len(sums)))
        out["n"] = [s.n for s in sums.values()]
        out["mean"] = [s.mean for s in sums.values()]
        out["cross"] = [s.cross.ravel() for s in sums.values()]
        return out

    def run(batches):
        sums: dict = {}
        for pdf in batches:
            parts = pdf.groupby(g, sort=False, dropna=False) if g else [((), pdf)]
            for key, part in parts:
                key = tuple(None if k is None or k != k else k for k in (key if isinstance(key, tuple) else (key,)))
                new = _Sums.of(part[cols].to_numpy(dtype=float))
                sums[key] = sums[key].merge(new) if key in sums else new
            if len(sums) > held:
                yield rows(sums)
                sums = {}
        if sums:
            yield rows(sums)

    return present.mapInPandas(run, schema)


def _merged(pdf: pd.DataFrame) -> _Sums:
    k = len(pdf["mean"].iloc[0])
    total = None
    for n, mean, cross in zip(pdf["n"], pdf["mean"], pdf["cross"]):
        one = _Sums(n, np.asarray(mean), np.asarray(cross).reshape(k, k))
        total = one if total is None else total.merge(one)
    return total


def fit_ols(df: DataFrame, group_cols, features, target: str, ridge=0.0) -> DataFrame:
    """Coefficient table ``(group..., term, coef)`` for ``target ~ 1 + features``.

    Rows with any null feature or target are skipped. ``ridge`` adds lambda
    to the diagonal of the centred system: a number, or the name of a group
    column (a parameter of the group). A group's task gets its block sums.
    """
    g, feats = as_list(group_cols), as_list(features)
    sums = block_sums(df, g, feats, target)
    schema = T.StructType([f for f in sums.schema.fields if f.name in g]
                          + [T.StructField("term", T.StringType()), T.StructField("coef", T.DoubleType())])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        s, k = _merged(pdf), len(feats)
        lam = float(pdf[ridge].iloc[0]) if isinstance(ridge, str) else ridge
        beta = np.linalg.lstsq(s.cross[:k, :k] + lam * np.eye(k), s.cross[:k, k], rcond=None)[0]
        out = pd.DataFrame({"term": ["intercept", *feats], "coef": [s.mean[k] - s.mean[:k] @ beta, *beta]})
        for name in g:
            out[name] = pdf[name].iloc[0]
        return out[[f.name for f in schema.fields]]

    return sums.groupBy(*g).applyInPandas(solve, schema)


def stage_coefficients(train: DataFrame, stages, group_cols, columns, target: str, ridge=0.0) -> DataFrame:
    """``(group..., stage, term, coef)``: for every stage a fit on what it may know of ``columns``."""
    fits = [fit_ols(train, group_cols, s.features(columns), target, ridge).withColumn("stage", F.lit(s.number)) for s in stages]
    return union_by_name(fits)


def predict_stages(test: DataFrame, coefs: DataFrame, group_cols, columns, out: str = "prediction") -> DataFrame:
    """Score each row by the coefficients of its group and ``stage``; a term the stage
    does not have counts as zero, a feature it has but the row lacks gives null."""
    g, feats = as_list(group_cols), as_list(columns)
    wide = stored(coefs.groupBy(*g, "stage").agg(F.map_from_entries(F.collect_list(F.struct("term", "coef"))).alias("__b")), "coefs")
    j = test.join(wide, on=[*g, "stage"], how="left")
    pred: Column = F.col("__b")["intercept"]
    for f in feats:
        pred = pred + F.when(F.col("__b")[f].isNull(), F.lit(0.0)).otherwise(F.col("__b")[f] * F.col(f))
    return j.select(*test.columns, pred.alias(out))


def predict_linear(df: DataFrame, coefs: DataFrame, group_cols, features, out: str = "prediction") -> DataFrame:
    """Join the (small) coefficient rows per group, stored so that the planner knows their
    size, and take the dot product."""
    g, feats = as_list(group_cols), as_list(features)
    wide = coefs.groupBy(*g).pivot("term", ["intercept"] + feats).agg(F.first("coef"))
    wide = stored(wide.select(*g, *[F.col(c).alias(f"__b_{c}") for c in ["intercept"] + feats]), "coefs")
    j = df.join(wide, on=g, how="left")
    pred: Column = F.col("__b_intercept")
    for f in feats:
        pred = pred + F.col(f"__b_{f}") * F.col(f)
    return j.select(*df.columns, pred.alias(out))


def residual_stack(train: DataFrame, test: DataFrame, group_cols, residual_keys, target: str,
                   pred: str = "prediction", out: str = "stacked") -> DataFrame:
    """Second stage on training residuals: add the mean residual of each
    ``residual_keys`` group to the first-stage prediction, clamp at 0."""
    rk = as_list(residual_keys)
    res = (train.where(F.col(pred).isNotNull() & F.col(target).isNotNull())
           .groupBy(*rk).agg(F.avg(F.col(target) - F.col(pred)).alias("__res")))
    j = test.join(res, on=rk, how="left")
    s = F.col(pred) + F.coalesce(F.col("__res"), F.lit(0.0))
    return j.select(*test.columns, F.when(s < 0, F.lit(0.0)).otherwise(s).alias(out))


def standard_scale(df: DataFrame, cols, group_cols=None, suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population std, over all rows or per group.

    Per group: aggregate and join back. Over all rows: one scalar subquery
    returning a struct of all statistics (one aggregate pass, no join).
    """
    cols, g = as_list(cols), as_list(group_cols)
    if not g:
        sq = df.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                             *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])).scalar()
        return df.select(*df.columns, *[((F.col(c) - sq[f"m_{c}"]) / sq[f"s_{c}"]).alias(f"{c}{suffix}")
                                        for c in cols])
    stats = df.groupBy(*g).agg(*[F.avg(c).alias(f"__m_{c}") for c in cols],
                               *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols])
    j = df.join(stats, on=g, how="left")
    return j.select(*df.columns, *[((F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}")).alias(f"{c}{suffix}")
                                   for c in cols])


def with_overrides(df: DataFrame, overrides: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Per-partition parameter columns: override row if present, else default.

    The default values are literals; how the override table is joined is left
    to the planner, since its size is the caller's; it is stored, so the
    planner knows that size.
    """
    o = stored(overrides.select(key, *[F.col(k).alias(f"__o_{k}") for k in defaults]), "overrides")
    j = df.join(o, on=key, how="left")
    return j.select(*df.columns, *[F.coalesce(F.col(f"__o_{k}"), F.lit(v)).alias(k) for k, v in defaults.items()])


def gbt_model(train: DataFrame, features, target: str, max_iter: int = 20, max_depth: int = 5, seed: int = 42, bins: int = 32):
    """Gradient-boosted trees (squared loss) with MLlib; returns (assembler, model).

    Features become the numbers of their bins, between thresholds found from all
    rows. Rows with the same bins always share a prediction, and the loss is
    squared, so MLlib grows the same trees on one row for each set of bins, with the mean of
    its targets, weighted by its rows: a number that the features and bins
    bound, however many the rows. Rows with a null feature are skipped, rows without target not used.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    feats = as_list(features)
    bucket, names = [f"__bucket_{f}" for f in feats], [f"__bin_{f}" for f in feats]
    train = train.dropna(subset=[*feats, target])
    # a threshold belongs to the values below it; Bucketizer wants one, also of a constant
    splits = [[-math.inf, *np.nextafter(t or [0.0], math.inf).tolist(), math.inf] for t in thresholds(train, feats, bins)]
    number = PipelineModel([
        Bucketizer(splitsArray=splits, inputCols=feats, outputCols=bucket, handleInvalid="skip"),
        # buckets are marked as categories, which trees would put in any order
        SQLTransformer(statement=f"SELECT *, {', '.join(f'`{b}` + 0D AS `{n}`' for b, n in zip(bucket, names))} FROM __THIS__")])
    va = VectorAssembler(inputCols=names, outputCol="__features")
    cells = stored(number.transform(train).groupBy(*names).agg(
        F.avg(F.col(target).cast("double")).alias("__label"), F.count(F.lit(1)).cast("double").alias("__weight")), "cells")
    # MLlib looks at as many rows as the square of maxBins for the values of a feature: at all of them
    gbt = GBTRegressor(featuresCol="__features", labelCol="__label", weightCol="__weight", maxIter=max_iter, maxDepth=max_depth,
                       seed=seed, maxBins=max(bins, math.isqrt(cells.count()) + 1))
    return PipelineModel([number, va]), gbt.fit(va.transform(cells))
