"""Predicted arrivals: a travel-time table by rounded distance and depth, and the joins on it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.functions.geo import haversine_km

KM_PER_DEGREE, EARTH_KM = 111.195, 6371.0
GRID_KM, DEFAULT_DEPTH = 5.0, 10.0
#: Depth of layer tops (km), P and S velocities (km/s) at them, of the public
#: iasp91 model; velocity is linear between rows.
IASP91 = [
    (0.0, 5.80, 3.36), (20.0, 5.80, 3.36), (20.0, 6.50, 3.75), (35.0, 6.50, 3.75), (35.0, 8.04, 4.47),
    (77.5, 8.045, 4.485), (120.0, 8.05, 4.50), (165.0, 8.175, 4.509), (210.0, 8.30, 4.518), (310.0, 8.665, 4.694), (410.0, 9.03, 4.870),
    (410.0, 9.36, 5.07), (660.0, 10.20, 5.60), (660.0, 10.79, 5.95), (760.0, 11.0558, 6.2095),
]
#: Below, down to the top of D": the model's cubics in the radius, as a share of the earth's.
_LOWER = ((25.1486, -41.1538, 51.9932, -26.6083), (12.9303, -21.2590, 27.8988, -14.1080))
IASP91 += [(z, *(sum(c * (1 - z / EARTH_KM) ** k for k, c in enumerate(cs)) for cs in _LOWER)) for z in range(800, 2741, 20)]
#: Rays are followed so far down at least, and so far below the source.
LEAST_BOTTOM, BELOW_SOURCE = 410.0, 50.0
#: Enough for a slowness to the last digit of a double.
HALVINGS = 60
#: Constant flat layers, top depth (km), P and S velocity (km/s) of each; the last is a half-space.
Layers = list[tuple[float, float, float]]
#: The crust of iasp91 over its uppermost mantle.
CRUST: Layers = [(0.0, 5.80, 3.36), (20.0, 6.50, 3.75), (35.0, 8.04, 4.47)]
PHASE_SETS = {"P": ("p", "P", "Pn", "Pg"), "S": ("s", "S", "Sn", "Sg")}


def _profile(speed: int, step: float = 1.0, bottom: float = LEAST_BOTTOM) -> tuple[np.ndarray, np.ndarray]:
    """Thin flat layers: top depths and velocities, flattened for the sphere; to the first row at or below ``bottom``."""
    depth, v = [], []
    rows = IASP91[: next((k for k, r in enumerate(IASP91) if r[0] >= bottom), len(IASP91) - 1) + 1]
    for (z0, *a), (z1, *b) in zip(rows, rows[1:], strict=False):
        if z1 > z0:
            edges = np.arange(z0, z1, step)
            mid = edges + np.minimum(step, z1 - edges) / 2
            depth += edges.tolist()
            v += (a[speed] + (b[speed] - a[speed]) * (mid - z0) / (z1 - z0)).tolist()
    return np.array([*depth, rows[-1][0]]), np.array(v)


def first_arrivals(distances: np.ndarray, depths: np.ndarray, phase: str = "P", layers: Layers | None = None) -> np.ndarray:
    """Seconds by depth and distance: the earlier of the direct ray and the head waves.

    Without ``layers`` the layers are thin ones of iasp91, flattened for the sphere: in these a
    turning ray is the head wave of the layer that it turns in. Both are exact for the layers. A
    direct ray's slowness is found by halving, as the one at which ``p x + tau(p)`` is greatest;
    a head wave's is its layer's, and it is there from its critical distance on.
    """
    x, z = np.asarray(distances, float), np.asarray(depths, float)
    column = 0 if phase == "P" else 1
    if layers is None:
        deepest = float(np.max(z, initial=0.0))
        if deepest > IASP91[-1][0]:
            raise ValueError(f"no velocities below {IASP91[-1][0]:g} km")
        edges, v = _profile(column, bottom=max(LEAST_BOTTOM, deepest + BELOW_SOURCE if deepest > LEAST_BOTTOM - BELOW_SOURCE else 0.0))
        radius = EARTH_KM - edges
        thick, speed = np.diff(EARTH_KM * np.log(EARTH_KM / radius)), v * EARTH_KM / ((radius[:-1] + radius[1:]) / 2)
    else:
        edges, speed = np.array([top for top, *_ in layers] + [np.inf]), np.array([row[1 + column] for row in layers], float)
        edges[-1] = max(edges[-2], float(np.max(z, initial=0.0))) + 1.0  # the half-space, as deep as it is asked for
        thick = np.diff(edges)
    slow = 1 / speed
    up = np.clip((z[:, None] - edges[:-1]) / np.diff(edges), 0, 1) * thick
    out = np.array([_direct(x, u[u > 0], slow[u > 0]) if (u > 0).any() else x * slow[0] for u in up]).reshape(len(z), len(x))
    # Layers faster than all above them carry head waves along their tops, from sources not below these.
    fast = [j for j in range(1, len(slow)) if slow[j] < slow[:j].min()]
    p = slow[fast]
    within = np.arange(len(slow)) < np.array(fast, int)[:, None]
    eta = np.sqrt(np.where(within, slow**2 - p[:, None] ** 2, 1.0))
    crossed = 2 * thick - up
    tau, critical = crossed @ np.where(within, eta, 0.0).T, crossed @ np.where(within, p[:, None] / eta, 0.0).T
    for i in range(len(z)):
        there = (edges[fast] >= z[i])[:, None] & (x >= critical[i][:, None])
        out[i] = np.minimum(out[i], np.where(there, p[:, None] * x + tau[i][:, None], np.inf).min(0, initial=np.inf))
    return out


def _direct(x: np.ndarray, thick: np.ndarray, slow: np.ndarray) -> np.ndarray:
    """Seconds of the ray straight through the layers above a source, to each distance."""
    low, high = np.zeros(len(x)), np.full(len(x), slow.min())
    for _ in range(HALVINGS):
        p = (low + high) / 2
        short = (thick * p[:, None] / np.sqrt(np.maximum(slow**2 - p[:, None] ** 2, 1e-300))).sum(1) < x
        low, high = np.where(short, p, low), np.where(short, high, p)
    return low * x + (thick * np.sqrt(slow**2 - low[:, None] ** 2)).sum(1)


def ray_table(spark: SparkSession, max_km: float = 500.0, max_depth: float = 100.0, grid_km: float = GRID_KM, cells: list[int] | None = None, layers: Layers | None = None) -> DataFrame:
    """``(phase, di, zi, tt)``: the lookup table, its size fixed by its arguments. ``cells`` are
    the depths' rows of the grid to make, if not all down to ``max_depth``; ``layers`` a model of
    one's own, if not iasp91."""
    distances = np.arange(0, max_km + grid_km, grid_km)
    zis = list(range(len(np.arange(0, max_depth + grid_km, grid_km)))) if cells is None else sorted(set(cells))
    depths = np.array(zis, float) * grid_km
    rows = [(ph, d, z, float(t)) for ph in PHASE_SETS for z, tt in zip(zis, first_arrivals(distances, depths, ph, layers), strict=True) for d, t in enumerate(tt.tolist())]
    return spark.createDataFrame(rows, "phase string, di int, zi int, tt double")


def iasp91_table(spark: SparkSession, max_km: float = 500.0, max_depth: float = 100.0, grid_km: float = GRID_KM) -> DataFrame:
    """The lookup table of the public model."""
    return ray_table(spark, max_km, max_depth, grid_km)


def catalogue_table(events: DataFrame, max_km: float = 500.0, grid_km: float = GRID_KM, layers: Layers | None = None) -> DataFrame:
    """The lookup table for all depths of a catalogue. Only its distinct depth cells reach the
    driver, at most one for each grid step down to the core; a depth below the model has none."""
    zi = grid_columns(F.lit(0.0), F.coalesce("depth", F.lit(DEFAULT_DEPTH)), grid_km)[1]
    found = events.select(zi.alias("zi")).where(F.col("zi") * grid_km <= IASP91[-1][0]).distinct().collect()
    return ray_table(events.sparkSession, max_km, grid_km=grid_km, cells=[r.zi for r in found], layers=layers)


def straight_table(spark: SparkSession, max_km: float = 500.0, max_depth: float = 100.0, grid_km: float = GRID_KM, vp: float = 6.0, vs: float = 3.5) -> DataFrame:
    """The same by straight rays at constant speeds: for checks that another engine must repeat."""
    d = spark.range(int(max_km / grid_km) + 2).select(F.col("id").cast("int").alias("di"), F.explode(F.sequence(F.lit(0), F.lit(int(max_depth / grid_km) + 1))).alias("zi"))
    path = F.sqrt(F.pow(F.col("di") * grid_km, 2) + F.pow(F.col("zi") * grid_km, 2))
    speeds = F.explode(F.map_from_arrays(F.array(F.lit("P"), F.lit("S")), F.array(F.lit(vp), F.lit(vs)))).alias("phase", "_v")
    return d.select("di", "zi", speeds).select("phase", "di", "zi", (path / F.col("_v")).alias("tt"))


def grid_columns(dist: Column | str, depth: Column | str, grid_km: float = GRID_KM, grid_depth_km: float | None = None) -> tuple[Column, Column]:
    """Cells of the grid: halves to the even cell, depths above ground at it."""
    d, z = (F.col(x) if isinstance(x, str) else x for x in (dist, depth))
    return F.rint(d / grid_km).cast("int"), F.rint(F.greatest(z, F.lit(0.0)) / (grid_depth_km or grid_km)).cast("int")


def with_travel_time(rows: DataFrame, table: DataFrame, phase: str, dist: str, depth: Column, out: str, grid_km: float = GRID_KM, grid_depth_km: float | None = None) -> DataFrame:
    """``rows`` with the first arrival of a phase set; null where the table has none."""
    di, zi = grid_columns(dist, depth, grid_km, grid_depth_km)
    lookup = table.where(F.col("phase") == phase).select(F.col("di").alias("_di"), F.col("zi").alias("_zi"), F.col("tt").alias(out))
    return rows.withColumns({"_di": di, "_zi": zi}).join(F.broadcast(lookup), ["_di", "_zi"], "left").drop("_di", "_zi")


def near_stations(events: DataFrame, stations: DataFrame, max_distance: float = 500.0, min_magnitude: float | None = None) -> DataFrame:
    """Events by the stations within reach, with ``dist``. Candidates meet by latitude bands, so
    no event is paired with a station too far north or south."""
    height = max_distance / KM_PER_DEGREE + 0.01
    s = stations.select("station", F.col("lat").alias("_slat"), F.col("lon").alias("_slon")).withColumn("_band", F.explode(F.sequence(F.floor((F.col("_slat") - height) / height), F.floor((F.col("_slat") + height) / height))))
    e = events.withColumn("_band", F.floor(F.col("lat") / height))
    near = e.join(s, "_band").withColumn("dist", haversine_km("_slat", "_slon", "lat", "lon")).where(F.col("dist") <= max_distance)
    if min_magnitude is not None:
        near = near.where(F.col("mag") >= min_magnitude)
    return near.drop("_band", "_slat", "_slon")


def predicted_arrivals(events: DataFrame, stations: DataFrame, table: DataFrame, max_distance: float = 500.0, grid_km: float = GRID_KM) -> DataFrame:
    """Events near each station with P and S times: ``tt_p, tt_s, p_epoch, s_epoch, sp_seconds``.

    Events are ``(event_id, t, lat, lon, depth, mag)``; a missing depth is ten kilometres; an
    event without a P arrival has no row, one without S has nulls.
    """
    depth = F.coalesce("depth", F.lit(DEFAULT_DEPTH))
    near = near_stations(events, stations, max_distance)
    timed = with_travel_time(with_travel_time(near, table, "P", "dist", depth, "tt_p", grid_km), table, "S", "dist", depth, "tt_s", grid_km)
    timed = timed.where("tt_p is not null")
    return timed.withColumns({"p_epoch": F.col("t") + F.col("tt_p"), "s_epoch": F.col("t") + F.col("tt_s"), "sp_seconds": F.col("tt_s") - F.col("tt_p")})


def inside(events: DataFrame, extent: DataFrame, keys: list[str]) -> DataFrame:
    """``events`` whose origin lies in a record, ``(keys, first, last)``, with the record's other columns."""
    return events.join(extent, keys).where((F.col("t") >= F.col("first")) & (F.col("t") <= F.col("last"))).drop("first", "last")


def grid_statistics(rows: DataFrame, dist: str = "dist", depth: str = "depth", grid_km: float = GRID_KM) -> DataFrame:
    """How much the grid saves: lookups, distinct cells and the share that would hit a cache."""
    di, zi = grid_columns(dist, F.coalesce(depth, F.lit(DEFAULT_DEPTH)), grid_km)
    cells = rows.select(di.alias("di"), zi.alias("zi")).groupBy("di", "zi").agg(F.count("*").alias("n"))
    return cells.agg(F.sum("n").alias("calls"), F.count("*").alias("distinct_cells")).withColumn("hits", F.col("calls") - F.col("distinct_cells")).withColumn("hit_rate", F.coalesce(F.try_divide("hits", "calls"), F.lit(0.0)))
