"""Generalised linear models (Tweedie family), one per group, by iteratively reweighted
least squares on merged block sums: one pass over the rows for each step of all
groups, and groups that have converged leave."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import as_list
from ..session import stored
from .forecast import _merged, _Sums

FARTHEST = 30.0  # of the linear predictor under the log link


def _weighted(x: np.ndarray, w: np.ndarray) -> _Sums:
    total = w.sum()
    mean = w @ x / total
    centred = x - mean
    return _Sums(float(total), mean, (centred * w[:, None]).T @ centred)


def _step_sums(rows: DataFrame, g, features, target: str, power: float, held: int = 2_000) -> DataFrame:
    """``group..., rows, n, mean, cross``: the weighted sums of [features, working
    response] at the coefficients ``beta`` of each row's group, by group and task."""
    feats = as_list(features)
    log_link = power > 0
    keys = [f for f in rows.schema.fields if f.name in g]
    schema = T.StructType(keys + [T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("rows", T.DoubleType()),
                                  T.StructField("n", T.DoubleType()), T.StructField("mean", T.ArrayType(T.DoubleType())),
                                  T.StructField("cross", T.ArrayType(T.DoubleType()))])

    def table(sums: dict) -> pd.DataFrame:
        out = pd.DataFrame(list(sums), columns=g)
        for name, pick in (("beta", lambda s: s[0]), ("rows", lambda s: s[1]), ("n", lambda s: s[2].n),
                           ("mean", lambda s: s[2].mean), ("cross", lambda s: s[2].cross.ravel())):
            out[name] = [pick(s) for s in sums.values()]
        return out

    def run(batches):
        sums: dict = {}
        for pdf in batches:
            for key, part in pdf.groupby(g, sort=False, dropna=False):
                beta = np.asarray(part["beta"].iloc[0], dtype=float)
                x, y = part[feats].to_numpy(dtype=float), part[target].to_numpy(dtype=float)
                eta = beta[0] + x @ beta[1:]
                if log_link:
                    eta = np.clip(eta, -FARTHEST, FARTHEST)
                    mu = np.exp(eta)
                    w, z = mu ** (2 - power), eta + (y - mu) / mu
                else:
                    w, z = np.ones(len(y)), y
                new = _weighted(np.column_stack([x, z]), w)
                key = tuple(None if k != k else k for k in key)
                old = sums.get(key)
                sums[key] = (beta, len(y), new) if old is None else (beta, old[1] + len(y), old[2].merge(new))
            if len(sums) > held:
                yield table(sums)
                sums = {}
        if sums:
            yield table(sums)

    return rows.select(*g, *feats, target, "beta").mapInPandas(run, schema)


def fit_tweedie(train: DataFrame, groups, features, target: str, power: float = 1.5, penalty: float = 0.0,
                steps: int = 25, tolerance: float = 1e-9) -> DataFrame:
    """``group..., beta, steps, converged``: intercept and coefficients of a Tweedie GLM of
    every group, with log link (identity for ``power`` 0, a normal model).

    Minimises half the mean deviance and half ``penalty`` times the squared
    coefficients (not the intercept), starting from the mean. A group whose
    coefficients move by less than ``tolerance`` has converged and leaves;
    others end after ``steps``. Rows with a null feature or target are not
    used; a group without a positive mean has only an intercept, the least
    linear predictor. A task holds the sums of its groups, never their rows.
    """
    g, feats = as_list(groups), as_list(features)
    cols = [*feats, target]
    rows = stored(train.select(*g, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols), "glm-rows")
    mean = F.avg(target)
    start = F.when(mean > 0, F.greatest(F.log(mean), F.lit(-FARTHEST))).otherwise(F.lit(-FARTHEST)) if power > 0 else mean
    zero = [F.lit(0.0)] * len(feats)
    fits = stored(rows.groupBy(*g).agg(F.array(start, *zero).alias("beta"), mean.alias("m")).select(
        *g, "beta", F.lit(0).alias("steps"), ((F.col("m") <= 0) if power > 0 else F.lit(False)).alias("converged")), "glm")
    keys = [f for f in fits.schema.fields if f.name in g]
    schema = T.StructType(keys + [T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("converged", T.BooleanType())])
    k = len(feats)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        s, old = _merged(pdf), np.asarray(pdf["beta"].iloc[0], dtype=float)
        system = s.cross[:k, :k] + penalty * float(pdf["rows"].sum()) * np.eye(k)
        slope = np.linalg.lstsq(system, s.cross[:k, k], rcond=None)[0]
        beta = np.array([s.mean[k] - s.mean[:k] @ slope, *slope])
        out = pdf[g].iloc[:1].copy()
        out["beta"] = [beta]
        out["converged"] = bool(np.max(np.abs(beta - old) / (1 + np.abs(old))) < tolerance)
        return out

    done = fits.where("converged")
    active = fits.where("NOT converged")
    for step in range(1, steps + 1):
        sums = _step_sums(rows.join(active.select(*g, "beta"), g), g, feats, target, power)
        fits = stored(sums.groupBy(*g).applyInPandas(solve, schema).withColumn("steps", F.lit(step)), "glm")
        active = fits.where("NOT converged")
        done = done.unionByName(fits.where("converged") if step < steps else fits)
        if step < steps and active.isEmpty():
            break
    return done.select(*g, "beta", "steps", "converged")


def predict_tweedie(rows: DataFrame, fits: DataFrame, groups, features, power: float = 1.5, out: str = "prediction") -> DataFrame:
    """``rows`` with the mean that their group's model gives; null for a null feature or
    a group without a model."""
    g, feats = as_list(groups), as_list(features)
    eta = F.get("beta", F.lit(0))
    for i, f in enumerate(feats, 1):
        eta = eta + F.get("beta", F.lit(i)) * F.col(f)
    eta = F.when(eta > FARTHEST, FARTHEST).when(eta < -FARTHEST, -FARTHEST).otherwise(eta)
    mean = F.exp(eta) if power > 0 else eta
    return rows.join(fits.select(*g, "beta"), g, "left").select(*rows.columns, mean.alias(out))


LEAST, START_AT = 1e-16, 0.1  # of the means, and that from which a target of zero starts, as in MLlib


class TweedieModel:
    """A fitted model; ``transform`` adds ``prediction`` and leaves out rows with a null feature."""

    def __init__(self, features, beta, steps: int):
        self.features, self.intercept, self.coefficients, self.steps = as_list(features), float(beta[0]), [float(b) for b in beta[1:]], steps

    def transform(self, rows: DataFrame) -> DataFrame:
        eta = F.lit(self.intercept)
        for f, b in zip(self.features, self.coefficients):
            eta = eta + F.lit(b) * F.col(f)
        mean = F.least(F.greatest(F.exp(eta), F.lit(LEAST)), F.lit(sys.float_info.max))
        return rows.dropna(subset=self.features).withColumn("prediction", mean)


def tweedie_glm(train: DataFrame, features, target: str, power: float = 1.1, max_iter: int = 25, tolerance: float = 1e-6) -> TweedieModel:
    """Global Tweedie GLM (log link, ``power`` from 1) by the steps of MLlib's
    GeneralizedLinearRegression: least squares on the logarithms of the targets, then at most
    ``max_iter`` reweighted ones, until no coefficient moves by ``tolerance``.

    The rows are written once, as numbers; a step is one pass of matrix products, of which
    the driver gets a few sums for each task. Rows with a null feature or target are not used;
    a negative target (from power 2 on also zero), or none at all, is an error.
    """
    if power < 1:
        raise ValueError("power must be 1 or more")
    feats = as_list(features)
    cols, k = [*feats, target], len(feats)
    rows = stored(train.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).dropna(), "glm-rows")

    def step(beta: np.ndarray | None) -> np.ndarray:
        def run(batches):
            total = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                x, y = x[:, :-1], x[:, -1]
                if (y < 0).any() or (power >= 2 and (y == 0).any()):
                    raise ValueError(f"{target} must not be {'negative' if power < 2 else 'zero or less'}")
                if beta is None:
                    first = np.maximum(y, START_AT) if power == 1 else np.where(y == 0, START_AT, y)
                    w, z = np.ones(len(y)), np.log(first)
                else:
                    eta = beta[0] + x @ beta[1:]
                    with np.errstate(over="ignore"):
                        mu = np.clip(np.exp(eta), LEAST, sys.float_info.max)
                    w, z = mu ** (2 - power), eta + (y - mu) / mu
                new = _weighted(np.column_stack([x, z]), w)
                total = new if total is None else total.merge(new)
            if total is not None:
                yield pa.RecordBatch.from_pydict({"n": [total.n], "mean": [total.mean.tolist()], "cross": [total.cross.ravel().tolist()]})

        parts = rows.mapInArrow(run, "n double, mean array<double>, cross array<double>").toPandas()
        if not len(parts):
            raise ValueError("no rows to fit a model to")
        s = _merged(parts)
        slope = _solved(s.cross[:k, :k], s.cross[:k, k])
        return np.array([s.mean[k] - s.mean[:k] @ slope, *slope])

    beta, steps = step(None), 0
    for steps in range(1, max_iter + 1):
        old, beta = beta, step(beta)
        if np.max(np.abs(beta - old)) < tolerance:
            break
    return TweedieModel(feats, beta, steps)


def _solved(cross: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least solution, at one scale of the features; those that do not vary have none."""
    scale = np.sqrt(np.diag(cross))
    scale[scale == 0] = 1.0
    return np.linalg.lstsq(cross / np.outer(scale, scale), right / scale, rcond=None)[0] / scale
