"""Time-ordered splits: multi-horizon stages, expanding-window folds, day masks."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_list
from ..session import stored, tasks_of


def horizon_split(df: DataFrame, partition_cols, date_col: str = "date", horizon: int = 12,
                  step: int = 4) -> DataFrame:
    """Adds ``cutoff`` (latest date of the partition minus ``horizon`` weeks),
    ``role`` ('train' / 'test' / null) and ``stage`` (1..horizon/step for test rows).

    Stage k tests weeks (k-1)*step+1 .. k*step after the cut-off. The per-
    partition maximum is an aggregate joined back (one row per partition),
    so a large partition is combined map-side instead of windowed in one task.
    It is stored, so the planner knows how small it is: rows are not shuffled
    by a few partition values.
    """
    parts = as_list(partition_cols)
    mx = stored(df.groupBy(*parts).agg(F.max(date_col).alias("_max")), "maxima")
    j = df.join(mx, on=parts, how="left")
    cutoff = F.date_sub("_max", 7 * horizon)
    weeks = F.datediff(date_col, cutoff) / 7.0
    stage = F.when((weeks > 0) & (weeks <= horizon), F.ceil(weeks / step).cast("int"))
    role = F.when(F.col(date_col) <= cutoff, F.lit("train")).when(stage.isNotNull(), F.lit("test"))
    return j.select(*df.columns, cutoff.alias("cutoff"), role.alias("role"), stage.alias("stage"))


@dataclass(frozen=True)
class Stage:
    """A forecast stage: weeks ``first``..``last`` after the cut-off, for which only
    what was known ``lag`` weeks before is a feature."""

    number: int
    first: int
    last: int
    lag: int
    lags: tuple[int, ...]

    def allows(self, column: str) -> bool:
        """Lagged columns (``.._lag_<weeks>..``) must be old enough, plain lags also one
        of the stage's; columns without a lag are always known."""
        found = _LAG.search(column)
        if found is None:
            return True
        weeks = int(found["weeks"])
        return weeks in self.lags if found["kind"] is None else weeks >= self.lag

    def features(self, columns) -> list[str]:
        return [c for c in columns if self.allows(c)]


_LAG = re.compile(r"(?:_(?P<kind>roll_mean|roll_std|ewm))?_lag_(?P<weeks>\d+)(?:_|$)")  # as windows.py names them


def stages(horizon: int = 12, step: int = 4, seasonal: tuple[int, ...] = ()) -> list[Stage]:
    """The stages of a horizon. A stage's plain lags are its own lag, the weeks of
    three further steps, and the ``seasonal`` ones."""
    return [Stage(k, (k - 1) * step + 1, min(k * step, horizon), k * step,
                  (*range(k * step, k * step + 3 * step + 1), *seasonal))
            for k in range(1, -(-horizon // step) + 1)]


def global_position(df: DataFrame, order, pos_col: str = "pos", total_col: str | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order`` (distributed).

    Range-partitioned sort, then per-task row counts (one row per task) are
    turned into offsets; no single-partition window over the data is
    involved. The sorted rows are written once with their task and number:
    a sort that ran twice could be cut differently, and its counts would not
    fit its rows. Ties in ``order`` take any order among themselves. The
    number of ranges follows the rows, which are stored first, since they are
    counted, sampled and sorted.
    ``total_col`` also attaches the total row count.
    """
    order = as_list(order)
    rows = stored(df, "unsorted")
    tasks = tasks_of(df.sparkSession, rows.count())
    ranges = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order) if tasks else rows.orderBy(*order)
    s = stored(ranges.select("*", F.spark_partition_id().alias("_pid"),
                                         F.monotonically_increasing_id().alias("_mid")), "positions")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_total"))
    # one row per task: bounded by the partition count
    j = s.join(F.broadcast(offsets), "_pid")
    extra = [F.col("_total").alias(total_col)] if total_col else []
    return j.select(*df.columns, (F.col("_off") + F.col("_mid") - F.col("_first")).alias(pos_col), *extra)


def ts_split(df: DataFrame, order, n_splits: int = 5, test_size: int | None = None,
             gap: int = 0) -> DataFrame:
    """Expanding-window folds over rows in time order.

    Adds ``pos`` and ``test_fold``: the fold (0-based) whose test block holds
    the row, or -1 for rows before every test block. Fold f trains on rows
    with ``test_fold < f`` (all earlier rows) and tests on ``test_fold == f``.
    The default test size is ``n // (n_splits + 1)``; the tests are the last
    ``n_splits * test_size`` rows.
    """
    pos = global_position(df, order, total_col="_n_rows")
    n = F.col("_n_rows")
    size = F.lit(test_size) if test_size else F.floor(n / (n_splits + 1))
    first_test = n - size * n_splits
    fold = F.when(F.col("pos") >= first_test, F.floor((F.col("pos") - first_test) / size)) \
            .otherwise(F.lit(-1))
    return pos.select(*df.columns, "pos", fold.cast("int").alias("test_fold"))


def day_split(df: DataFrame, day_col: str, train_end: int, test_end: int, start: int = 0) -> DataFrame:
    """Role by integer day: train ``start..train_end``, test ``train_end+1..test_end``."""
    d = F.col(day_col)
    role = F.when((d >= start) & (d <= train_end), "train").when((d > train_end) & (d <= test_end), "test")
    return df.select("*", role.alias("role"))
