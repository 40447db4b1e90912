"""Price features over a (keys, period) price panel.

Expected input: one price per key and period (for example a weekly price per
store and item), with ``month`` and ``year`` columns of the period. Window
partitions are then bounded by the number of periods of a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_list
from ..functions.columns import signed_fraction
from ..session import stored, tasks_of

MONEY = "decimal(38,8)"


def money_mean(c: str, window=None):
    """Mean of a money column summed exactly in DECIMAL, then one division.

    Summing doubles depends on the order of addition; for prices, which are
    short decimals, the exact mean often sits on a rounding tie, so an
    order-dependent last bit would change the rounded result between runs.
    """
    total = F.sum(F.col(c).cast(MONEY))
    n = F.count(c)
    if window is not None:
        total, n = total.over(window), n.over(window)
    return total.cast("double") / n


def price_features(df: DataFrame, keys, price: str, order: str,
                   month: str = "month", year: str = "year") -> DataFrame:
    """Adds ``{p}_max/min/std/mean/nunique``, ``{p}_norm``, ``{p}_nunique_{rest}``,
    ``{p}_momentum``, ``{p}_momentum_m``, ``{p}_momentum_y``, ``{p}_cent``,
    ``{p}_max_cent``, ``{p}_min_cent``.

    The prices are stored once and their rows, narrow until the last step, visit the
    rows of an equal price and all keys but one, once for each key, and then their key, so they
    are shuffled once more than there are keys. A distinct count is a sum of the
    first rows of a key and price; a sum over a window needs no aggregate that
    is shuffled as well and no rows that are shuffled to meet it. One task holds
    the rows of a window (those of a price beyond memory are spilled); the number of
    tasks follows the rows. Rows with a null key have no statistics.
    """
    keys = as_list(keys)
    p = price
    df = stored(df, "prices")
    tasks = tasks_of(df.sparkSession, df.count())
    number = [tasks] if tasks else []  # else the planner's
    out, counts = df, []
    for col in keys:
        rest = [k for k in keys if k != col]
        name = f"{p}_nunique_{'_'.join(rest)}"
        by = [*rest, F.xxhash64(p)]  # windows take doubles as equal that rows are not laid by: NaN, -0.0
        out = out.repartition(*number, *by)
        if not counts:
            nth = F.row_number().over(Window.partitionBy(*by, p, col).orderBy(order))
            out = out.withColumn("__first", F.when(F.col(p).isNotNull() & (nth == 1), 1))
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*rest, p]])
        found = F.sum(F.when(F.col(col).isNotNull(), F.col("__first"))).over(Window.partitionBy(*by, p))
        out = out.withColumn(name, F.when(known, F.coalesce(found, F.lit(0).cast("long"))))
        counts.append(name)
    own = Window.partitionBy(*keys)
    w = own.orderBy(order)
    wm = Window.partitionBy(*keys, month)
    wy = Window.partitionBy(*keys, year)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    stats = {"max": F.max(p).over(own), "min": F.min(p).over(own), "std": F.stddev_samp(p).over(own),
             "mean": money_mean(p, own), "nunique": F.sum("__first").over(own)}
    others = [c for c in df.columns if c not in keys and c != p]
    out = out.repartition(*number, *keys).select(
        *df.columns, *counts, *[F.when(known, c).alias(f"{p}_{s}") for s, c in stats.items()],
        (F.col(p) / F.lag(p).over(w)).alias(f"{p}_momentum"),
        (F.col(p) / money_mean(p, wm)).alias(f"{p}_momentum_m"),
        (F.col(p) / money_mean(p, wy)).alias(f"{p}_momentum_y"))
    return out.select(
        *keys[:-1], p, keys[-1], *others, *[f"{p}_{s}" for s in stats],
        (F.col(p) / F.col(f"{p}_max")).alias(f"{p}_norm"), *counts,
        f"{p}_momentum", f"{p}_momentum_m", f"{p}_momentum_y",
        signed_fraction(p).alias(f"{p}_cent"),
        signed_fraction(f"{p}_max").alias(f"{p}_max_cent"),
        signed_fraction(f"{p}_min").alias(f"{p}_min_cent"),
    )
