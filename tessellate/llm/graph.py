"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _with_minimum(sym: DataFrame) -> DataFrame:
    """Each (u, v) with ``m``, the least of u and its neighbours. The minimum is
    aggregated before the shuffle and stored, so that the join shuffles both
    sides itself and can split the rows of a hub."""
    low = stored(sym.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "least")
    return sym.join(low, F.col("u") == F.col("w")).select("u", "v", F.least("u", "m").alias("m"))


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``(node, root)`` for every node that has an edge; root is the least node
    of its component.

    Alternates the two star operations of Kiveris et al.: every node hangs its
    larger neighbours, then its smaller ones, below their least neighbour. The
    edges become stars around the least nodes after a number of rounds that is
    logarithmic in the longest path. Each round's edges go to the shared
    folder; only a count and a checksum come to the driver. Rows with a null
    end and self-links are ignored; an empty edge list gives no rows.
    """
    e = (edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
         .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stored(e, "links")
    seen = None
    while True:
        sym = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_minimum(sym).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        w = _with_minimum(large)
        e = stored(w.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(w.select("u", F.col("m").alias("v")))
                   .where(F.col("u") != F.col("v")).distinct(), "links")
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = tuple(mark)
