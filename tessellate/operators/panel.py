"""Panel construction: period aggregation and dense (gap-free) series.

A panel is long format: one row per key and period. The dense form has a row
for every period from the key's release (first period with a positive value)
to a common end, with missing periods filled with 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_list
from ..functions.calendar import to_day, week_bucket
from ..session import stored, tasks_of


def keys_not_null(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in as_list(keys)])


def period_aggregate(df: DataFrame, keys, date_col: str, value: str | None,
                     how: str = "sum", period: str = "week", target: str = "qty",
                     out_date: str = "date") -> DataFrame:
    """Sum (or count of non-null ``value``) per key and period.

    Null keys are dropped like a pandas groupby; a sum over only nulls is 0.
    The aggregate is partial (map-side combine) before the shuffle on
    ``keys + period``, so a hot key is spread over its periods.
    """
    keys = as_list(keys)
    bucket = week_bucket(date_col) if period == "week" else to_day(date_col)
    if how == "sum":
        agg = F.coalesce(F.sum(value), F.lit(0)).alias(target)
    elif how == "count":
        agg = (F.count(value) if value else F.count(F.lit(1))).alias(target)
    else:
        raise ValueError(how)
    return (df.where(keys_not_null(keys))
            .groupBy(*keys, bucket.alias(out_date)).agg(agg))


def densify(panel: DataFrame, keys, date_col: str = "date", target: str = "qty",
            end=None, step_days: int = 7, release_col: str = "release") -> DataFrame:
    """Gap-free series from each key's release to ``end``; age in periods.

    Instead of crossing all keys with the whole calendar and filtering, each
    existing row emits the periods up to the next existing row of its key
    (``lead``), so only the rows that survive are ever produced. Rows of a key
    live in one window partition, whose size is bounded by the number of
    periods in the span (not by the fact volume). The number of tasks follows
    the rows of the dense panel, which later windows on the keys sort;
    ``panel`` is stored, since its periods are counted first.

    ``end``: last period to keep (a date literal / Column); default is the
    latest period in ``panel`` (a scalar subquery).
    """
    return _dense(panel, keys, date_col, target, end, step_days, release_col)[0]


def _dense(panel: DataFrame, keys, date_col: str, target: str, end=None, step_days: int = 7,
           release_col: str = "release") -> tuple[DataFrame, int | None]:
    """``densify``, and the number of tasks that hold its rows by key (None: the planner's)."""
    keys = as_list(keys)
    if end is None:
        end_col = panel.agg(F.max(to_day(date_col))).scalar()
    elif isinstance(end, Column):
        end_col = end
    else:
        end_col = F.to_date(F.lit(str(end)))
    w = Window.partitionBy(*keys).orderBy(date_col)
    wk = Window.partitionBy(*keys)
    d = to_day(date_col)
    step = F.expr(f"INTERVAL {step_days} DAY")
    panel = stored(panel.where(keys_not_null(keys)), "facts")
    first = panel.groupBy(*keys).agg(F.min(d).alias("_first")).select("_first", end_col.alias("_end"))
    periods = F.greatest(F.datediff("_end", "_first"), F.lit(0)) / step_days + 1
    tasks = tasks_of(panel.sparkSession, first.agg(F.sum(periods)).first()[0])
    if tasks:
        panel = panel.repartition(tasks, *keys)
    staged = (panel
              .select(*keys, d.alias("_d"), F.col(target).alias("_v"),
                      F.min(F.when(F.col(target) > 0, d)).over(wk).alias("_rel"),
                      F.lead(d).over(w).alias("_next"), end_col.alias("_end"))
              .where((F.col("_d") >= F.col("_rel")) & (F.col("_d") <= F.col("_end"))))
    last = F.least(F.coalesce(F.date_sub("_next", step_days), F.col("_end")), F.col("_end"))
    filled = staged.select(*keys, "_d", "_v", "_rel",
                           F.explode(F.sequence("_d", last, step)).alias(date_col))
    dense = filled.select(
        *keys, date_col,
        F.when(F.col(date_col) == F.col("_d"), F.coalesce("_v", F.lit(0)))
         .otherwise(F.lit(0)).cast(panel.schema[target].dataType).alias(target),
        (F.datediff(date_col, "_rel") / F.lit(7.0)).alias(release_col),
    )
    return dense, tasks


def spine_fill(panel: DataFrame, calendar, keys, date_col: str = "date",
               target: str = "qty", end=None, kept: str | None = None) -> DataFrame:
    """Dense weekly panel joined with weekly calendar attributes.

    ``calendar``: a ``WeeklyCalendar`` (bounded by the range of dates, so it is
    broadcast; its last week is the default end) or a plain DataFrame
    (joined normally; AQE decides).
    The big side keeps its key partitioning for later windows. With ``kept`` the
    panel is stored under that name, a large one in buckets of its keys.
    """
    from .calendar import WeeklyCalendar
    if isinstance(calendar, WeeklyCalendar):
        frame = F.broadcast(calendar.frame)
        if end is None:
            end = calendar.last_week
    else:
        frame = calendar
    dense, tasks = _dense(panel, keys, date_col, target, end)
    cal_cols = [c for c in frame.columns if c != date_col]
    out = (dense.join(frame, date_col, "left")
           .select(*as_list(keys), date_col, *cal_cols, target, "release"))
    return stored(out, kept, as_list(keys), tasks) if kept else out
