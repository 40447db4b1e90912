"""tessellate: panel / time-series features and incremental loads on Spark DataFrames.

Every public operator is a function ``DataFrame -> DataFrame`` with explicit
keys and ordering columns, built from Spark SQL expressions so Catalyst can
prune, push down and plan the shuffles.
"""

__version__ = "0.1.0"

# Functions of this package used inside Python UDFs (grouped pandas, map in
# pandas) are pickled by value, so executors need no installed copy.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
