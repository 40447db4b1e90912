"""Series features over ``Window.partitionBy(keys).orderBy(order)``.

All same-spec windows are emitted in one ``select`` so Spark plans a single
exchange and sort for them. Rolling statistics use the identity
``rolling(shift(x, l), w) == shift(rolling(x, w), l)``: each (window,
statistic) frame is evaluated once and then lagged, instead of one sliding
frame per (lag, window) pair.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import as_list
from ..session import stored, tasks_of


def _gate(keys) -> Column:
    """pandas group transforms give null on rows with a null key."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in as_list(keys)])


def lag_name(target: str, lag: int) -> str:
    return f"{target}_lag_{lag}"


def roll_name(target: str, stat: str, lag: int, window: int) -> str:
    return f"{target}_roll_{stat}_lag_{lag}_win_{window}"


def ewm_name(target: str, lag: int, alpha: float) -> str:
    return f"{target}_ewm_lag_{lag}_alpha_{str(alpha).replace('.', '')}"


def lag_columns(keys, order, target: str, lags) -> list[Column]:
    w = Window.partitionBy(*as_list(keys)).orderBy(*as_list(order))
    g = _gate(keys)
    return [F.when(g, F.lag(target, int(l)).over(w)).alias(lag_name(target, l)) for l in lags]


def lag_features(df: DataFrame, keys, order, target: str, lags) -> DataFrame:
    return df.select("*", *lag_columns(keys, order, target, lags))


# Sums are exact: values, and squares as the nearest double, are added as decimals
# with so many digits after the point, so they do not depend on the order.
EXACT = "decimal(38,10)"
FEW = 100_000  # rows of a table that is broadcast
NULL_ROWS = 10_000  # without a key that are gathered together
NOISE = 1e-14  # share of the squares below which a sum of squared deviations is zero


def exact(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double").cast(EXACT)


def moments(target: str) -> list[Column]:
    """``_n, _s, _q``: count, exact sum and exact sum of squares, which merge by addition."""
    x = F.col(target).cast("double")
    return [F.count(target).alias("_n"), F.sum(exact(x)).alias("_s"), F.sum(exact(x * x)).alias("_q")]


def mean_of(n: Column, s: Column) -> Column:
    return F.when(n > 0, s.cast("double") / n)


def std_of(n: Column, s: Column, q: Column) -> Column:
    """Sample deviation from moments; null below two values."""
    s, q = s.cast("double"), q.cast("double")
    spread = q - s * s / n
    return F.when(n > 1, F.when(spread <= NOISE * q, F.lit(0.0)).otherwise(F.sqrt(spread / (n - 1))))


def rolling_features(df: DataFrame, keys, order, target: str, windows, lags,
                     stats=("mean", "std")) -> DataFrame:
    """``{target}_roll_{stat}_lag_{l}_win_{w}`` for every lag x window x stat.

    A value needs all ``w`` observations present (pandas ``min_periods=w``).
    A window's moments are the difference of two running ones, ``w`` rows apart;
    these are exact, so nothing is lost, and a long window costs as much as a
    short one.
    """
    keys, order = as_list(keys), as_list(order)
    base = Window.partitionBy(*keys).orderBy(*order)
    upto = base.rowsBetween(Window.unboundedPreceding, 0)
    g = _gate(keys)
    x = F.col(target).cast("double")
    running = {"_n": F.count(target), "_s": F.sum(exact(x))} | ({"_q": F.sum(exact(x * x))} if "std" in stats else {})
    summed = df.select("*", *[c.over(upto).alias(f"_run{n}") for n, c in running.items()])
    tmp, values, parts = {}, [], []
    for win in windows:
        win = int(win)
        of = {}
        for n in running:
            now, before = F.col(f"_run{n}"), F.coalesce(F.lag(f"_run{n}", win).over(base), F.lit(0))
            parts.append((F.coalesce(now, F.lit(0)) - before).alias(f"_{win}{n}"))
            of[n] = F.col(f"_{win}{n}")
        full = of["_n"] == win
        for stat in stats:
            tmp[(stat, win)] = f"__{stat}_{win}"
            value = mean_of(of["_n"], of["_s"]) if stat == "mean" else std_of(of["_n"], of["_s"], of["_q"])
            values.append(F.when(full, value).alias(tmp[(stat, win)]))
    staged = summed.select(*df.columns, *parts).select(*df.columns, *values)
    out = [F.when(g, F.lag(tmp[(stat, win)], int(lag)).over(base)).alias(roll_name(target, stat, lag, win))
           for lag in lags for win in windows for stat in stats]
    return staged.select(*df.columns, *out)


def ewm_features(df: DataFrame, keys, order, target: str, alphas, lags, tasks: int | None = None) -> DataFrame:
    """``{target}_ewm_lag_{l}_alpha_{a}``: lagged exponentially weighted means.

    Semantics of pandas ``ewm(alpha).mean()`` with default arguments: adjusted
    weights, nulls still advance the decay, a null row repeats the last value,
    leading nulls give null; rows with a null key get null.

    A key's rows are gathered into one (bounded by its number of periods), whose
    values alone cross Arrow, as the group of a window on the keys, and are
    spread again with the means. Unlike rows that went through ``mapInPandas``,
    these still lie by key for the planner: neither the rows before nor the means, which
    hardly compress, are shuffled for the windows on the same keys that follow.
    Only unlagged means cross Arrow: ``ewm(shift(x, l)) == shift(ewm(x), l)``, and
    the lags are windows. Rows with a null key belong to no series and are gathered by
    ``NULL_ROWS``. ``tasks`` of a large ``df`` (``session.tasks_of``) that does not lie
    by key sort it, else the planner's.
    """
    keys, order = as_list(keys), as_list(order)
    alphas, lags = [float(a) for a in alphas], [int(l) for l in lags]
    base_of = {a: f"__ewm_{i}" for i, a in enumerate(alphas)}
    cols = df.columns
    rest = [*order, *[c for c in cols if c not in keys and c not in order]]

    def means(series: pd.Series) -> list:
        x = pd.Series(np.asarray(series.iloc[0], dtype="float64"))
        return [x.ewm(alpha=a).mean().to_numpy() for a in alphas]

    if tasks:
        df = df.repartition(tasks, *keys)
    part = F.when(~_gate(keys), F.floor(F.monotonically_increasing_id() / NULL_ROWS))
    series = (df.withColumn("__part", part).groupBy(*keys, "__part")
              .agg(F.sort_array(F.collect_list(F.struct(*rest))).alias("__rows")))
    means_of = F.pandas_udf(means, "array<array<double>>")
    found = series.select(*keys, "__rows", means_of(F.transform("__rows", lambda r: r[target].cast("double")))
                          .over(Window.partitionBy(*keys, "__part")).alias("__means"))
    beside = found.select(*keys, "__rows", *[F.get("__means", F.lit(i)).alias(n) for i, n in enumerate(base_of.values())])
    staged = (beside.select(*keys, F.inline(F.arrays_zip("__rows", *base_of.values())))
              .select(*[F.col(c) if c in keys else F.col("__rows")[c].alias(c) for c in cols],
                      *[F.when(~F.isnan(n) & _gate(keys), F.col(n)).alias(n) for n in base_of.values()]))
    w = Window.partitionBy(*keys).orderBy(*order)
    lagged = [(F.when(_gate(keys), F.lag(base_of[a], l).over(w)) if l else F.col(base_of[a])).alias(ewm_name(target, l, a))
              for l in lags for a in alphas]
    return staged.select(*cols, *lagged)


def target_encoding(df: DataFrame, target: str, enc_cols, as_of: str | None = None,
                    stats_from: DataFrame | None = None, unique_keys=None, laid_by=None) -> DataFrame:
    """``enc_{cols}_mean`` / ``enc_{cols}_std`` of ``target`` per group of columns.

    Default uses all rows of the group, including the
    evaluation period. With ``as_of`` (a date/order column) only rows of the
    group with a strictly earlier ``as_of`` value are used (leak-free).

    One aggregate reads the rows for all column sets: exact moments of the
    finest groups (and periods), which grouping sets add up; it is stored, and
    each set's part of it. One of at most ``FEW`` rows is broadcast: rows are not
    shuffled by a few groups. A larger part is joined by so many tasks as the rows
    need; without periods it first meets the part of a larger set that has all its columns, so
    rows are shuffled once for both (unless a null in the larger set's columns would
    hide a group of the smaller). Rows that lie in buckets of ``laid_by`` meet the part of these columns
    there and keep their order. The as-of form adds
    its moments up in a running window of a row for each (group, period).
    ``unique_keys``, whose rows have a period each, run over the rows themselves,
    before the joins, where a dense panel still lies by its keys.
    """
    sets = [as_list(c) for c in enc_cols]
    own = [c for c in sets if as_of is not None and unique_keys is not None and set(c) == set(as_list(unique_keys))]
    joined = [c for c in sets if c not in own]
    period = [as_of] if as_of is not None else []
    out, large = df, []
    if joined:
        every = list(dict.fromkeys(c for cols in joined for c in cols))
        source = (stats_from if stats_from is not None else df)
        fine = source.groupBy(*every, *period).agg(*moments(target), F.count(F.lit(1)).alias("_rows"))
        add_up = [F.sum(c).alias(c) for c in ("_n", "_s", "_q", "_rows")]
        table = stored(fine.groupingSets([[F.col(c) for c in [*cols, *period]] for cols in joined], *[F.col(c) for c in [*every, *period]])
                       .agg(F.grouping_id().alias("_set"), *add_up), "encodings")
        places = [*every, *period]
        held = tasks_of(df.sparkSession, table.count())
        # every set adds up all rows
        tasks = tasks_of(df.sparkSession, table.groupBy("_set").agg(F.sum("_rows").alias("n")).agg(F.max("n")).first()[0])
    for cols in [*own, *joined]:
        name = "_".join(cols)
        m, s = f"enc_{name}_mean", f"enc_{name}_std"
        base_cols = out.columns
        n, total, squares = F.col("_n"), F.col("_s"), F.col("_q")
        if cols in own:
            w = Window.partitionBy(*cols).orderBy(as_of).rowsBetween(Window.unboundedPreceding, -1)
            x = F.col(target).cast("double")
            run = out.select("*", F.count(target).over(w).alias("_n"), F.sum(exact(x)).over(w).alias("_s"),
                             F.sum(exact(x * x)).over(w).alias("_q"))
            out = run.select(*base_cols, F.when(_gate(cols), mean_of(n, total)).alias(m),
                             F.when(_gate(cols), std_of(n, total, squares)).alias(s))
            continue
        # the bits of columns that a set leaves out, the first column highest
        number = sum(1 << (len(places) - 1 - i) for i, c in enumerate(places) if c not in [*cols, *period])
        part = table.where(F.col("_set") == number)
        stats = part.where(_gate(cols))
        if as_of is not None:
            w = Window.partitionBy(*cols).orderBy(as_of).rowsBetween(Window.unboundedPreceding, -1)
            if held:
                stats = stats.repartition(held, *cols)
            stats = stats.select(*cols, as_of, *[F.sum(c).over(w).alias(c) for c in ("_n", "_s", "_q")])
        stats = stored(stats.select(*cols, *period, mean_of(n, total).alias(m), std_of(n, total, squares).alias(s)), "encoding")
        if stats.count() > FEW:
            large.append((cols, stats, as_of is None and stats_from is None and part.where(~_gate(cols)).isEmpty()))
        else:
            out = out.join(F.broadcast(stats), on=[*cols, *period], how="left").select(*base_cols, m, s)
    large.sort(key=lambda part: len(part[0]))
    while large:
        cols, stats, _ = large.pop(0)
        host = next((i for i, (others, _, whole) in enumerate(large) if whole and set(cols) < set(others)), None)
        if host is not None:
            others, more, whole = large[host]
            large[host] = others, more.join(stats, on=cols, how="left"), whole
            continue
        on = [*cols, *period]
        if laid_by is not None and set(on) == set(as_list(laid_by)):
            stats = stats.hint("shuffle_hash")
        elif tasks:
            out, stats = (x.repartition(tasks, *on) for x in (out, stats))
        out = out.join(stats, on=on, how="left")
    names = [f"enc_{'_'.join(c)}_{stat}" for c in sets for stat in ("mean", "std")]
    return out.select(*df.columns, *names)
