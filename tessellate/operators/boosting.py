"""Boosted trees with the Tweedie objective, one model per group, all groups grown at once.

Histogram boosting as Spark aggregates: features become small bin numbers
once; each level of each tree is one aggregate of gradient sums per (group,
node, feature, bin) with map-side combine, and a window over the bins finds the
best cut. Trees are rows of a table; a group's rows never meet in a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_list
from ..session import stored
from .quantiles import _same

EXACT = "decimal(28,9)"  # gradients are summed as decimals, so that equal cuts have equal gains


def ranked_values(rows: DataFrame, groups, features) -> DataFrame:
    """``group..., feature, value, n, last, rank, all``: how many of the group's rows have
    each value of each feature (by its number), how many that or a lesser one, the value's
    place among the distinct ones, from 1, and all rows that have one. A null has ``n`` 0.

    Equal values are counted before the shuffle and their counts sorted by
    (group, feature, value) over all tasks; a running sum within each task's part of
    a group, after the counts of its earlier parts, tells which ranks a value has.
    """
    g, feats = as_list(groups), as_list(features)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f).cast("double").alias("value")) for i, f in enumerate(feats)]))
    counts = (rows.select(*g, each.alias("one")).groupBy(*g, "one.feature", "one.value").agg(F.count("*").alias("n"))
              .withColumn("n", F.when(F.col("value").isNull(), 0).otherwise(F.col("n"))))
    ranges = stored(counts.orderBy(*g, "feature", "value").select("*", F.spark_partition_id().alias("part")), "value-counts")
    of, present = [*g, "feature"], F.col("value").isNotNull().cast("long")
    earlier = Window.partitionBy(*of).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    renamed = [f"_{c}" for c in [*of, "part"]]
    parts = ranges.groupBy(*of, "part").agg(F.sum("n").alias("held"), F.sum(present).alias("values")).select(
        *[F.col(c).alias(r) for c, r in zip([*of, "part"], renamed)], F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum("values").over(earlier), F.lit(0)).alias("values_before"), F.sum("held").over(Window.partitionBy(*of)).alias("all"))
    upto = Window.partitionBy(*of, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranges.withColumns({"upto": F.sum("n").over(upto), "place": F.sum(present).over(upto)})
    return ranked.join(stored(parts, "value-parts"), _same([*of, "part"], renamed)).select(
        *of, "value", "n", (F.col("before") + F.col("upto")).alias("last"),
        (F.col("values_before") + F.col("place")).alias("rank"), "all")


def cut_points(train: DataFrame, groups, features, bins: int = 100) -> DataFrame:
    """``group..., cuts``: per feature the distinct exact ``bins``-quantiles of the group's rows."""
    g, feats = as_list(groups), as_list(features)
    ranked = ranked_values(train, g, feats)
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    is_cut = F.exists(probs, lambda p: F.ceil(p * F.col("all")).between(F.col("last") - F.col("n") + 1, F.col("last")))
    cuts = ranked.groupBy(*g, "feature").agg(F.sort_array(F.collect_set(F.when(is_cut, F.col("value")))).alias("cuts"))
    by_feature = cuts.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("feature", "cuts"))).alias("of"))
    return stored(by_feature.select(*g, F.array(*[F.col("of")[i] for i in range(len(feats))]).alias("cuts")), "cut-points")


def thresholds(rows: DataFrame, features, bins: int = 32) -> list[list[float]]:
    """For each feature at most ``bins - 1`` values halfway between neighbouring ones, by
    the rule of MLlib's trees, but from all rows: all of them if they are so few, else the
    first after each threshold before which ``1 / bins`` more of the rows lie
    than before the last one. The driver gets ``bins`` numbers and pairs of values a feature."""
    feats = as_list(features)
    ranked = stored(ranked_values(rows, [], feats).where("n > 0"), "ranked-values")
    # halfway between r - 1 and r, the rows before lie closer to the aim than those up to r
    past = 2 * F.col("last") - F.col("n")
    firsts = ranked.groupBy("feature").agg(F.max("rank").alias("values"), F.array(*[
        F.min(F.when((F.col("rank") > 1) & (past * bins > 2 * j * F.col("all")), F.col("rank"))) for j in range(1, bins)]).alias("firsts"))
    picked: dict[int, list[int]] = {}
    for row in firsts.collect():
        at, ranks = 1, []
        for first in (r for r in row["firsts"] if r is not None):
            at = max(at + 1, first)
            ranks.append(at)
        picked[row["feature"]] = list(range(2, row["values"] + 1)) if row["values"] <= bins else [r for r in ranks if r <= row["values"]]
    near = [(F.col("feature") == i) & F.col("rank").isin(sorted({*ranks, *(r - 1 for r in ranks)})) for i, ranks in picked.items() if ranks]
    value = {(r["feature"], r["rank"]): r["value"] for r in ranked.where(reduce(lambda a, b: a | b, near)).collect()} if near else {}
    return [sorted({(value[i, r - 1] + value[i, r]) / 2 for r in picked.get(i, [])}) for i in range(len(feats))]


def binned(rows: DataFrame, cuts: DataFrame, groups, features) -> DataFrame:
    """``rows`` with ``bins``: for each feature the number of cut points below it, plus one;
    nulls have bin 0, so a cut can part them from all others."""
    g = as_list(groups)

    def number(cuts: Column, x: Column) -> Column:
        return F.when(x.isNull(), F.lit(0)).otherwise(F.size(F.filter(cuts, lambda c: c < x)) + 1)

    numbers = [number(F.col("cuts")[i], F.col(f).cast("double")) for i, f in enumerate(as_list(features))]
    return rows.join(cuts, g).select(*rows.columns, F.array(*numbers).alias("bins"))


def _node(splits: Column, depth: int) -> Column:
    """Node that a row's ``bins`` lead to: the children of n are 2n (at most the cut) and 2n + 1."""
    def step(n, _):
        cut = F.try_element_at(splits, n)
        return F.when(cut.isNull(), n).otherwise(2 * n + F.when(F.get("bins", cut["feature"]) > cut["bin"], 1).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(1), step) if depth else F.lit(1)


def _as_map(table: DataFrame, g, value: Column, name: str) -> DataFrame:
    return table.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct(F.col("node"), value))).alias(name))


def _gradients(power: Column, n: Column, s: Column, f: Column) -> list[Column]:
    """First and second derivative of the Tweedie deviance by the raw score (log link), of
    ``n`` rows with the sum ``s``."""
    a, b = F.exp((1 - power) * f), F.exp((2 - power) * f)
    return [(n * b - s * a).cast(EXACT).alias("g"), (n * (2 - power) * b - s * (1 - power) * a).cast(EXACT).alias("h")]


def _best_cuts(rows: DataFrame, g, min_rows: int) -> DataFrame:
    """``group..., node, feature, bin``: the cut with the greatest gain of each node, if
    there is any gain (equal gains: the first feature, the lowest bin)."""
    hist = (rows.select(*g, "node", "g", "h", "n", F.posexplode("bins").alias("feature", "bin"))
            .groupBy(*g, "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]))
    of = Window.partitionBy(*g, "node", "feature")
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.select(*g, "node", "feature", "bin", *[F.sum(c).over(w).alias(f"{side}{c}") for side, w in (("l", upto), ("t", of))
                                                      for c in ("g", "h", "n")])
    d = lambda c: c.cast("double")
    lg, lh, tg, th = (F.col(c) for c in ("lg", "lh", "tg", "th"))
    gain = (d(lg) * d(lg) / d(lh) + d(tg - lg) * d(tg - lg) / d(th - lh) - d(tg) * d(tg) / d(th))
    fits = (F.col("ln") >= min_rows) & (F.col("tn") - F.col("ln") >= min_rows) & (lh > 0) & (th - lh > 0)
    gains = sums.where(fits).withColumn("gain", gain).where("gain > 0")
    best = F.max_by(F.struct("feature", "bin"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("best")
    return gains.groupBy(*g, "node").agg(best).select(*g, "node", "best.feature", "best.bin")


def fit_trees(train: DataFrame, groups, target: str, trees: int = 100, depth: int = 4, min_rows: int = 20,
              feature_share: float = 1.0, row_share: float = 1.0, freq: int = 1) -> DataFrame:
    """``group..., tree, splits, leaves`` (maps by node) for ``train`` rows with ``bins``,
    ``target`` and the group's parameters ``power`` and ``rate``.

    The raw score starts at 0; a leaf adds ``-rate * G / H`` of its rows. Rows of a
    group with the same bins always have the same score, so they are added up
    once, to their number and the exact sum of their targets, and the trees
    grow on these cells. With ``feature_share`` each tree sees the features, with
    ``row_share`` the rows (drawn anew every ``freq`` trees), that a hash of their
    values and the tree's number picks. Rows without target are not used.
    """
    g = as_list(groups)
    used = train.where(F.col(target).isNotNull())
    parameters = [F.first(F.col(c).cast("double")).alias(c) for c in ("power", "rate")]

    def cells(rows):
        y = F.sum(F.col(target).cast("double").cast("decimal(38,9)")).cast("double")
        return rows.groupBy(*g, "bins").agg(F.count("*").alias("n"), y.alias("s"), *parameters)

    score = stored(cells(used).withColumn("f", F.lit(0.0)), "scores")
    out = []
    for t in range(trees):
        if row_share < 1 and t % freq == 0:
            drawn = stored(cells(used.where(F.pmod(F.xxhash64(F.lit(t), *used.columns), F.lit(1_000_000)) < int(row_share * 1_000_000))),
                           "drawn").select(*g, "bins", "n", "s")
        picked = score if row_share == 1 else score.drop("n", "s").join(drawn, [*g, "bins"])
        if feature_share < 1:
            share = F.transform("bins", lambda b, i: F.when(
                F.pmod(F.xxhash64(F.lit(t), i), F.lit(1_000_000)) < int(feature_share * 1_000_000), b).otherwise(0))
            picked = picked.withColumn("bins", share)
        picked = picked.select(*g, "bins", "n", "rate", *_gradients(*map(F.col, ("power", "n", "s", "f"))))
        cuts, splits = [], None
        at = lambda rows, d: rows.withColumn("node", F.lit(1)) if splits is None else rows.join(
            splits, g, "left").withColumn("node", _node(F.col("splits"), d))
        for d in range(depth):
            level = at(picked, d).where(F.col("node") >= 1 << d)
            cuts.append(stored(_best_cuts(level, g, min_rows), "cuts"))
            splits = _as_map(reduce(DataFrame.union, cuts), g, F.struct("feature", "bin"), "splits")
        sums = at(picked, depth).groupBy(*g, "node").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.first("rate").alias("rate"))
        value = F.when(F.col("h") > 0, -F.col("rate") * F.col("g").cast("double") / F.col("h").cast("double")).otherwise(F.lit(0.0))
        leaves = _as_map(sums, g, value, "leaves")
        tree = stored(leaves.join(splits, g, "left").select(*g, F.lit(t).alias("tree"), "splits", "leaves"), "tree")
        out.append(tree)
        if t + 1 < trees:
            grown = F.col("f") + F.coalesce(F.try_element_at("leaves", _node(F.col("splits"), depth)), F.lit(0.0))
            score = stored(score.join(tree, g).select(*g, "bins", "n", "s", "power", "rate", grown.alias("f")), "scores")
    return reduce(DataFrame.union, out)


def predict_trees(rows: DataFrame, trees: DataFrame, groups, depth: int, out: str = "prediction") -> DataFrame:
    """``rows`` with the exponential of the sum of the leaves that their ``bins`` lead to;
    null for groups without trees."""
    g = as_list(groups)
    model = trees.groupBy(*g).agg(F.sort_array(F.collect_list(F.struct("tree", F.map_entries("splits").alias("s"),
                                                                      F.map_entries("leaves").alias("l")))).alias("trees"))
    model = model.select(*g, F.transform("trees", lambda t: F.struct(
        F.map_from_entries(t["s"]).alias("splits"), F.map_from_entries(t["l"]).alias("leaves"))).alias("trees"))
    total = F.aggregate("trees", F.lit(0.0), lambda f, t: f + F.coalesce(
        F.try_element_at(t["leaves"], _node(t["splits"], depth)), F.lit(0.0)))
    return rows.join(model, g, "left").select(*rows.columns, F.exp(total).alias(out))
