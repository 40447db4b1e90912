"""Search of penalised regressions over a grid and expanding folds, from one pass.

Counts, means and cross-products of each (group, fold) are all that a search
needs: training sums of a fold are those of earlier blocks merged, a whole path
of penalties follows from them without the rows, and the error on the fold's
own block is a quadratic form of its sums.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import as_list
from .forecast import _Sums, block_sums

SWEEPS, STILL = 2_000, 1e-12  # of the coordinate descent: at most, and the change at which it ends


def ridge_path(cross: np.ndarray, xy: np.ndarray, penalties) -> np.ndarray:
    """Solutions of (cross + p) b = xy for all penalties, by one eigendecomposition."""
    values, vectors = np.linalg.eigh(cross)
    turned = vectors.T @ xy
    floor = max(values.max(initial=0.0), 1.0) * 1e-13  # directions without spread get no coefficient
    return np.array([vectors @ np.where(values + p > floor, turned / np.where(values + p > floor, values + p, 1), 0.0)
                     for p in penalties])


def elastic_path(cross: np.ndarray, xy: np.ndarray, alphas, l1_ratio: float) -> np.ndarray:
    """Elastic net by coordinate descent on the cross-products, from the largest penalty
    to the smallest, each starting at the one before; in the order of ``alphas``."""
    alphas = np.asarray(alphas, dtype=float)
    b, out = np.zeros(len(xy)), np.zeros((len(alphas), len(xy)))
    for i in np.argsort(-alphas, kind="stable"):
        l1, l2 = alphas[i] * l1_ratio, alphas[i] * (1 - l1_ratio)
        for _ in range(SWEEPS):
            moved = 0.0
            for j in range(len(b)):
                if cross[j, j] <= 0:
                    continue
                rest = xy[j] - cross[j] @ b + cross[j, j] * b[j]
                new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (cross[j, j] + l2)
                moved, b[j] = max(moved, abs(new - b[j])), new
            if moved < STILL:
                break
        out[i] = b
    return out


def path_scores(df: DataFrame, groups, fold_col: str, features, target: str, alphas, l1_ratios) -> DataFrame:
    """``group..., fold, alpha, l1_ratio, n_train, n_test, rmse`` of every candidate.

    Rows of a fold are tested by fits on all rows of earlier folds (of the same
    group); a fold of -1 only trains. Features are scaled by the training
    rows' deviation; the loss is half the mean squared error, ``alpha`` times
    ``l1_ratio`` the absolute and half of (1 - ``l1_ratio``) the squared
    coefficients. Rows with a null feature or target are not used; a fold
    without training or test rows has no score. A group's task gets a few
    block sums of each fold.
    """
    g, feats = as_list(groups), as_list(features)
    sums = block_sums(df, [*g, fold_col], feats, target)
    keys = [f for f in sums.schema.fields if f.name in g]
    schema = T.StructType(keys + [T.StructField("fold", T.LongType())] + [
        T.StructField(n, T.DoubleType()) for n in ("alpha", "l1_ratio")] + [
        T.StructField(n, T.LongType()) for n in ("n_train", "n_test")] + [T.StructField("rmse", T.DoubleType())])
    k = len(feats)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks: dict = {}
        for fold, n, mean, cross in zip(pdf[fold_col], pdf["n"], pdf["mean"], pdf["cross"]):
            one = _Sums(n, np.asarray(mean), np.asarray(cross).reshape(k + 1, k + 1))
            blocks[int(fold)] = blocks[int(fold)].merge(one) if int(fold) in blocks else one
        rows, train = [], None
        for fold in sorted(blocks):
            test = blocks[fold]
            if fold >= 0 and train is not None:
                scale = np.sqrt(np.diag(train.cross)[:k] / train.n)
                scale = np.where(scale > 0, scale, 1.0)
                cross = train.cross[:k, :k] / np.outer(scale, scale) / train.n
                xy = train.cross[:k, k] / scale / train.n
                for ratio in l1_ratios:
                    path = ridge_path(cross, xy, alphas) if ratio == 0 else elastic_path(cross, xy, alphas, ratio)
                    for alpha, scaled in zip(alphas, path):
                        slope = scaled / scale
                        shift = test.mean[k] - train.mean[k] - (test.mean[:k] - train.mean[:k]) @ slope
                        error = np.append(-slope, 1.0)
                        mse = max(error @ test.cross @ error / test.n + shift * shift, 0.0)
                        rows.append((fold, float(alpha), float(ratio), int(train.n), int(test.n), float(np.sqrt(mse))))
            train = test if train is None else train.merge(test)
        out = pd.DataFrame(rows, columns=["fold", "alpha", "l1_ratio", "n_train", "n_test", "rmse"])
        for name in g:
            out[name] = pdf[name].iloc[0]
        return out[[f.name for f in schema.fields]]

    return sums.groupBy(*g).applyInPandas(search, schema)


def mean_scores(scores: DataFrame, groups) -> DataFrame:
    """``group..., alpha, l1_ratio, folds, mean_rmse, worst_rmse`` of every candidate over the folds."""
    return scores.groupBy(*as_list(groups), "alpha", "l1_ratio").agg(
        F.count("*").alias("folds"), F.avg("rmse").alias("mean_rmse"), F.max("rmse").alias("worst_rmse"))
