"""Exact quantiles of large groups by narrowing histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions._util import as_list
from ..session import stored


CELLS = 1024  # of a histogram


def _same(left, right):
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def quantiles(df: DataFrame, keys, value: str, probs=(0.0, 0.25, 0.5, 0.75, 1.0), cells: int = CELLS) -> DataFrame:
    """Exact quantiles ``q0, q1, ...`` (linear interpolation) of ``value`` per group, for all
    groups at once and whatever their size.

    A wanted rank starts with the range from the group's least to its greatest
    value. Each pass counts the rows of every open range in ``cells`` cells,
    takes the cell that holds the rank, and goes on between the least and the
    greatest value of that cell, until they are equal. The ends of a range are
    cells of their own, so each pass makes it smaller. Ranges of a group are
    equal or disjoint, so a row is counted once a pass; tasks add up before the
    shuffle, and no task holds more of a group than a histogram.

    Nulls and NaN are left out; null keys are a group; a group without values
    and an empty table give no row.
    """
    keys = as_list(keys)
    if not keys:  # one group
        return quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probs, cells).drop("_all")
    v = F.col(value).cast("double")
    rows = stored(df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v")), "quantile-rows")
    position = F.col("_p") * (F.col("_n") - 1)
    ranks = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
             .withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
             .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))))
             .select(*keys, "_rank", "_lo", "_hi", F.col("_rank").alias("_in")).distinct())
    ranks = stored(ranks, "quantile-ranks")
    closed = [ranks.where("_lo = _hi")]
    ranges = [*keys, "_lo", "_hi"]
    renamed = [f"r_{c}" for c in ranges]
    share = (F.col("_v") / 2 - F.col("r__lo") / 2) / (F.col("r__hi") / 2 - F.col("r__lo") / 2)  # halves do not overflow
    cell = (F.when(F.col("_v") == F.col("r__lo"), -1).when(F.col("_v") == F.col("r__hi"), cells + 1)
            .otherwise(F.floor(F.nanvl(share, F.lit(0.5)) * cells)).cast("int"))
    upto = F.sum("_c").over(W.partitionBy(*renamed).orderBy("_cell"))
    remaining = ranks.where("_lo < _hi")
    while not remaining.isEmpty():
        open_ranges = remaining.select(*[F.col(c).alias(r) for c, r in zip(ranges, renamed)]).distinct()
        counted = (rows.join(open_ranges, _same(keys, renamed[:-2]) & F.col("_v").between(F.col("r__lo"), F.col("r__hi")))
                   .groupBy(*renamed, cell.alias("_cell"))
                   .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
                   .withColumn("_upto", upto))
        ranks = stored(remaining.join(counted, _same(ranges, renamed) & (F.col("_in") < F.col("_upto")) & (F.col("_in") >= F.col("_upto") - F.col("_c")))
                       .select(*keys, "_rank", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"),
                               (F.col("_in") - (F.col("_upto") - F.col("_c"))).alias("_in")), "quantile-ranks")
        closed.append(ranks.where("_lo = _hi"))
        remaining = ranks.where("_lo < _hi")
    found = reduce(DataFrame.union, closed)
    of_rank = (found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_lo"))).alias("_at")))
    sizes = rows.groupBy(*[F.col(k).alias(f"s_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    out = of_rank.join(sizes, _same(keys, [f"s_{k}" for k in keys]))

    def at(p: float):
        place = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = (F.element_at("_at", f(place)) for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))

    return out.select(*keys, *[at(p).alias(f"q{i}") for i, p in enumerate(probs)])
