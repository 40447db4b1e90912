"""Nearest-point lookup and per-location series by haversine distance.

Exact k-nearest search without a cross join: every point becomes a unit
vector in 3-D and is bucketed in a cubic grid of side ``h``. A location joins
only the stations in the (2m+1)^3 cells around its own (an equi-join on cell
id). The straight-line (chord) distance to any point outside that block is
at least the distance from the location to the block's boundary, and the
great-circle distance is a monotone function of the chord, so when the k-th
nearest candidate is within that guaranteed radius the answer is exact;
otherwise the location is retried with a block twice as wide. Rounds only
carry unresolved locations, and the cell size follows the station count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import as_col
from ..session import cut_lineage

EARTH_KM = 6371.0088
SMALLEST_CELL = 2e-6  # about 13 m; cell numbers stay within a long


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = (as_col(c) for c in (lat1, lon1, lat2, lon2))
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(a))


def _unit(lat, lon):
    p, l = F.radians(as_col(lat)), F.radians(as_col(lon))
    return F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)


def _cell_id(ix, iy, iz, k: int) -> Column:
    m = 2 * k + 1
    return ((ix + k) * m + (iy + k)) * m + (iz + k)


def k_nearest(locations: DataFrame, stations: DataFrame, k: int = 5, loc_id: str = "loc_id",
              st_id: str = "st_id", cell: float | None = None) -> DataFrame:
    """``(loc_id, st_id, distance_km, rank)`` for the ``k`` nearest stations.

    ``locations``: loc_id, lat, lon; ``stations``: st_id, lat, lon, ... .
    Ranks break distance ties by station id. ``cell``: grid side on the unit
    sphere; by default about ``k`` stations per occupied cell. The rounds end
    when every location is resolved or the block covers the sphere, so each
    location has all its stations whatever the cell.
    """
    if cell is None:
        n = max(stations.count(), 1)  # one scalar
        cell = min(1.0, max(1e-4, math.sqrt(16 * math.pi * k / n)))
    cell = max(cell, SMALLEST_CELL)
    sx, sy, sz = _unit("lat", "lon")
    stations_u = stations.select(st_id, F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"),
                                 sx.alias("_sx"), sy.alias("_sy"), sz.alias("_sz"))
    x, y, z = _unit("lat", "lon")
    pending = locations.select(loc_id, "lat", "lon", x.alias("_x"), y.alias("_y"), z.alias("_z"))
    done = None
    size = cell
    while True:
        half = int(math.ceil(1.0 / size)) + 1
        st = stations_u.select(st_id, "s_lat", "s_lon", _cell_id(
            F.floor(F.col("_sx") / size), F.floor(F.col("_sy") / size), F.floor(F.col("_sz") / size), half)
            .alias("cell"))
        offs = F.sequence(F.lit(-1), F.lit(1))
        ix, iy, iz = (F.floor(F.col(c) / size) for c in ("_x", "_y", "_z"))
        guard = F.least(*[F.least(F.col(c) - (i - 1) * size, (i + 2) * size - F.col(c))
                          for c, i in (("_x", ix), ("_y", iy), ("_z", iz))])
        loc = (pending.select("*", guard.alias("guard"), ix.alias("_ix"), iy.alias("_iy"), iz.alias("_iz"))
               .select("*", F.explode(offs).alias("_dx"))
               .select("*", F.explode(offs).alias("_dy"))
               .select("*", F.explode(offs).alias("_dz"))
               .select(loc_id, "lat", "lon", "guard",
                       _cell_id(F.col("_ix") + F.col("_dx"), F.col("_iy") + F.col("_dy"),
                                F.col("_iz") + F.col("_dz"), half).alias("cell")))
        pairs = loc.join(st, "cell").select(
            loc_id, st_id, "guard", haversine_km("lat", "lon", "s_lat", "s_lon").alias("distance_km"))
        w = Window.partitionBy(loc_id).orderBy("distance_km", st_id)
        top = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        worst = top.groupBy(loc_id).agg(F.max("distance_km").alias("_kth"), F.count(F.lit(1)).alias("_n"),
                                        F.first("guard").alias("_g"))
        covers_all = size >= 2.0  # the 3x3x3 block then contains the whole sphere
        guard_km = F.lit(2 * EARTH_KM) * F.asin(F.least(F.col("_g"), F.lit(2.0)) / 2)
        ok = worst.where(F.lit(covers_all) | ((F.col("_n") >= k) & (F.col("_kth") <= guard_km))).select(loc_id)
        res = top.join(ok, loc_id, "left_semi").select(loc_id, st_id, "distance_km", "rank")
        done = res if done is None else done.unionByName(res)
        if covers_all:
            break
        # reliable checkpoint in the shared folder: cuts the lineage that grows
        # every round and survives the loss of the executor holding it
        pending = cut_lineage(pending.join(ok, loc_id, "left_anti"))
        if pending.isEmpty():
            break
        size *= 2  # coarser grid, still 27 cells per location
    return done


def nearest_with_data(locations: DataFrame, stations: DataFrame, k: int = 5, loc_id: str = "loc_id",
                      st_id: str = "st_id", has_data: str = "daily_end", cell: float | None = None) -> DataFrame:
    """Of the ``k`` nearest stations keep those with data, then the nearest."""
    top = k_nearest(locations, stations, k, loc_id, st_id, cell)
    flag = stations.select(st_id, has_data)
    with_data = top.join(flag, st_id).where(F.col(has_data).isNotNull())
    w = Window.partitionBy(loc_id).orderBy("rank")
    return (with_data.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1)
            .select(loc_id, st_id, "distance_km", "rank"))


def station_series(assignments: DataFrame, daily: DataFrame, st_id: str = "st_id",
                   loc_cols=("loc_id",)) -> DataFrame:
    """Attach each chosen station's daily series to its location (one join
    on station id, instead of a fetch-and-concatenate loop)."""
    return assignments.select(*loc_cols, st_id).join(daily, st_id)
