"""Capacity-limited nearest-neighbour tours (K4, K5) of small and of hot groups.

A vehicle goes to the nearest open stop of its (plan, depot) group that still fits
(ties: the lowest stop id) until none fits, then returns; the next one starts at
the depot.

* ``Field`` holds a bounded number of open stops in blocks of neighbours.  Blocks
  whose bounding circle is farther than the best stop found are not looked at, so
  a step costs about the square root of the stops.
* ``tours_local`` walks a whole group in one task (groups up to a limit).
* ``tours_leased`` walks hot groups by leases.  A group's open stops lie in tiles
  (a written table sorted by tile, and an index with each tile's circle, number of
  open stops and smallest demand).  In a round every group's vehicle gets a window:
  the nearest stops around it from the tiles within its reach, at most ``WINDOW`` of
  them (or a lease, if that is more).  One task takes lease after lease of at most
  ``lease`` stops from the window and walks each as long as the next stop is surely
  nearer than anything outside it.  Where that can't be told from the window either,
  the vehicle's state is handed to the next round.  A round is a few jobs, whatever
  the number of groups, and the rounds of a group grow with its stops by window, not
  by lease.
"""

from __future__ import annotations

import os
import sys
import uuid

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroute.functions.columns import EARTH_RADIUS_KM, haversine_km
from stockroute.session import ensure_checkpoint_dir
from stockroute.sources.schemas import ROUTE_SCHEMA

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers need no installed package

MARGIN_KM = 1e-6
TILE_STOPS = 256
LEASE = 20_000
WINDOW = 8_192                  # stops that a round hands to a group's task, at least
KEYS = ["plan_id", "depot_idx"]
_ROUTE = ROUTE_SCHEMA.fieldNames()
_STATE = "depot_name string, depot_lat double, depot_lon double, v int, c_lat double, c_lon double, " \
         "load double, total double, ord int, stuck boolean"
_STATE_NAMES = [c.split()[0] for c in _STATE.split(", ")]
_WALK = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ROUTE_SCHEMA) + ", tile long, " + _STATE


def hav_np(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = (np.sin(np.radians(lat2 - lat1) / 2) ** 2
         + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2)
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(a))


# ------------------------------------------------------------------ stops in one task
class Field:
    """Open stops by blocks; ``nearest`` and ``take`` keep them up to date."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, demand: np.ndarray, ids: np.ndarray):
        self.lat, self.lon, self.demand, self.ids = lat, lon, demand, ids
        self._build(np.arange(len(ids)))

    def _build(self, members: np.ndarray) -> None:
        n = len(members)
        size = int(min(max(n ** 0.5, 16), 512))
        strips = max(1, int((n / size) ** 0.5))
        strip = np.empty(n, np.int64)
        strip[np.argsort(self.lat[members], kind="stable")] = np.arange(n) * strips // max(n, 1)
        self.at = members[np.lexsort((self.lon[members], strip))]
        self.first = np.arange(0, n, size)
        self.last = np.minimum(self.first + size, n)
        self.block = np.empty(len(self.ids), np.int64)
        self.block[self.at] = np.arange(n) // size
        self.open = np.zeros(len(self.ids), bool)
        self.open[members] = True
        self.left, self.built = n, n
        blocks = range(len(self.first))
        parts = [self.at[a:b] for a, b in zip(self.first, self.last)]
        self.b_lat = np.array([(self.lat[p].min() + self.lat[p].max()) / 2 for p in parts])
        self.b_lon = np.array([(self.lon[p].min() + self.lon[p].max()) / 2 for p in parts])
        self.b_rad = np.array([hav_np(self.b_lat[i], self.b_lon[i], self.lat[p], self.lon[p]).max()
                               for i, p in zip(blocks, parts)]) + MARGIN_KM
        self.b_least = np.array([self.demand[p].min() for p in parts])
        self.b_left = np.array([len(p) for p in parts])

    def nearest(self, lat: float, lon: float, load: float, capacity: float) -> tuple[int, float]:
        """Index and distance of the nearest open stop that fits, or (-1, inf)."""
        best, best_km = -1, np.inf
        if not self.left:
            return best, best_km
        low = hav_np(lat, lon, self.b_lat, self.b_lon) - self.b_rad
        low[(self.b_left == 0) | ~(load + self.b_least <= capacity)] = np.inf
        while True:
            b = int(np.argmin(low))
            if low[b] == np.inf or low[b] > best_km:
                return best, best_km
            low[b] = np.inf
            p = self.at[self.first[b]:self.last[b]]
            p = p[self.open[p] & (load + self.demand[p] <= capacity)]
            if not len(p):
                continue
            km = hav_np(lat, lon, self.lat[p], self.lon[p])
            least = km.min()
            if least <= best_km:
                i = int(p[km == least][np.argmin(self.ids[p[km == least]])])
                if least < best_km or self.ids[i] < self.ids[best]:
                    best, best_km = i, float(least)

    def take(self, i: int) -> None:
        self.open[i] = False
        self.left -= 1
        self.b_left[self.block[i]] -= 1
        if self.left < self.built // 2 and self.built > 64:
            self._build(np.flatnonzero(self.open))


def tour_group(pdf: pd.DataFrame, n_vehicles: int, capacity: float) -> pd.DataFrame:
    """All tours of one group; a vehicle that serves nobody emits no rows."""
    plan, didx = int(pdf["plan_id"].iat[0]), int(pdf["depot_idx"].iat[0])
    dname = str(pdf["depot_name"].iat[0])
    dlat, dlon = float(pdf["depot_lat"].iat[0]), float(pdf["depot_lon"].iat[0])
    field = Field(*(pdf[c].to_numpy(float) for c in ("lat", "lon", "demand")), pdf["stop_id"].to_numpy(np.int64))
    names = pdf["stop_name"].astype(str).to_numpy()
    rows = []
    for v in range(n_vehicles):
        vid = f"V{didx + 1}_{v + 1}"
        clat, clon, load, total, order = dlat, dlon, 0.0, 0.0, 1
        served = [(plan, didx, vid, 0, -1, dname, dlat, dlon, 0.0, 0.0, 0.0, 0.0, True)]
        while True:
            k, km = field.nearest(clat, clon, load, capacity)
            if k < 0:
                break
            field.take(k)
            clat, clon = float(field.lat[k]), float(field.lon[k])
            load += field.demand[k]
            total += km
            served.append((plan, didx, vid, order, int(field.ids[k]), names[k], clat, clon,
                           field.demand[k], load, km, total, False))
            order += 1
        if len(served) > 1:
            back = float(hav_np(clat, clon, dlat, dlon))
            total += back
            served.append((plan, didx, vid, order, -1, f"{dname} (return)", dlat, dlon, 0.0,
                           load, back, total, True))
            rows.extend(served)
    return pd.DataFrame(rows, columns=_ROUTE)


def tours_local(tagged: DataFrame, n_vehicles: int, capacity: float) -> DataFrame:
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return tour_group(pdf, n_vehicles, capacity)
    return tagged.groupBy(*KEYS).applyInPandas(fn, ROUTE_SCHEMA)


# ------------------------------------------------------------------ leases of hot groups
def _nearest_of(place: tuple[float, float], lat: np.ndarray, lon: np.ndarray, ids: np.ndarray,
                lease: int) -> tuple[np.ndarray, float]:
    """Places (in the arrays) of the nearest ``lease`` stops, ties by id, and the farthest one's distance."""
    km = hav_np(*place, lat, lon)
    near = np.flatnonzero(km <= np.partition(km, lease - 1)[lease - 1])
    near = near[np.lexsort((ids[near], km[near]))[:lease]]
    return near, float(km[near[-1]])


def walk(pdf: pd.DataFrame, n_vehicles: int, capacity: float, lease: int, window: int | None = None) -> pd.DataFrame:
    """Walk one group's vehicle through its window, lease after lease.

    Rows carry the vehicle's state, the window's stops (none: a null stop_id) and
    ``reach``, the distance beyond which stops may be missing (null: none is).
    Returns route rows (stops with their tile) and, while the group goes on, one
    row with the new state and no Stop_Order.
    """
    s = pdf.iloc[0]
    plan, didx, v = int(s["plan_id"]), int(s["depot_idx"]), int(s["v"])
    dname, dlat, dlon = str(s["depot_name"]), float(s["depot_lat"]), float(s["depot_lon"])
    clat, clon, load, total, order = (float(s["c_lat"]), float(s["c_lon"]), float(s["load"]),
                                      float(s["total"]), int(s["ord"]))
    reach = np.inf if pd.isna(s["reach"]) else float(s["reach"])
    got = pdf[pdf["stop_id"].notna()]
    lat, lon, demand = (got[c].to_numpy(float) for c in ("lat", "lon", "demand"))
    ids, tiles = got["stop_id"].to_numpy(np.int64), got["tile"].to_numpy(np.int64)
    names = got["stop_name"].astype(str).to_numpy()
    if len(got) >= (lease if window is None else window):
        reach = min(reach, float(hav_np(clat, clon, lat, lon).max()))
    begin, steps, vid, rows = (clat, clon), 0, f"V{didx + 1}_{v + 1}", []
    left = np.arange(len(ids))
    none = [None] * (1 + len(_STATE_NAMES))

    def route(*values, tile=None):
        rows.append([plan, didx, vid, *values, tile, *none[1:]])

    while True:
        start, before = (clat, clon), steps
        left = left[load + demand[left] <= capacity]
        of, around = left, reach if not steps else reach - float(hav_np(*begin, *start)) - MARGIN_KM
        if len(left) > lease:
            near, last = _nearest_of(start, lat[left], lon[left], ids[left], lease)
            of, around = left[near], min(around, last)
        field = Field(lat[of], lon[of], demand[of], ids[of])
        while True:
            k, km = field.nearest(clat, clon, load, capacity)
            if (clat, clon) == start:   # distances are those the lease was chosen by
                sure = k >= 0 and (km <= around - (MARGIN_KM if steps > before else 0.0)
                                   or km == 0.0 and (steps > before or start == begin))
            else:
                sure = km <= around - float(hav_np(*start, clat, clon)) - MARGIN_KM
            if k < 0 or not sure:
                break
            if order == 1:
                route(0, -1, dname, dlat, dlon, 0.0, 0.0, 0.0, 0.0, True)
            field.take(k)
            i = of[k]
            clat, clon, steps = float(lat[i]), float(lon[i]), steps + 1
            load += demand[i]
            total += km
            route(order, int(ids[i]), names[i], clat, clon, demand[i], load, km, total, False, tile=int(tiles[i]))
            order += 1
        if steps == before or len(of) == len(left):
            break                       # the window has nothing else to tell
        left = np.setdiff1d(left, of[~field.open], assume_unique=True)
    goes_on = True
    if k < 0 and reach == np.inf:       # nothing open fits any more
        goes_on = order > 1 and v + 1 < n_vehicles
        if order > 1:
            back = float(hav_np(clat, clon, dlat, dlon))
            route(order, -1, f"{dname} (return)", dlat, dlon, 0.0, load, back, total + back, True)
        v, clat, clon, load, total, order, steps = v + 1, dlat, dlon, 0.0, 0.0, 1, 1
    if goes_on:
        rows.append([plan, didx, *[None] * (len(_ROUTE) - 2), None,
                     dname, dlat, dlon, v, clat, clon, load, total, order, steps == 0])
    return pd.DataFrame(rows, columns=[*_ROUTE, "tile", *_STATE_NAMES]).astype(
        {"Stop_Order": "Int32", "stop_id": "Int64", "Is_Depot": "boolean", "tile": "Int64",
         "v": "Int32", "ord": "Int32", "stuck": "boolean"})


def _tiled(stops: DataFrame) -> DataFrame:
    """Stops with their tile: a grid of each group with about TILE_STOPS stops a cell."""
    box = stops.groupBy(*KEYS).agg(F.count("*").alias("_n"), F.min("lat").alias("_s"), F.max("lat").alias("_t"),
                                   F.min("lon").alias("_w"), F.max("lon").alias("_e"))
    side = F.ceil(F.sqrt(F.col("_n") / TILE_STOPS)).cast("long")
    at = lambda c, low, high: F.least(
        F.floor((F.col(c) - F.col(low)) / F.greatest(F.col(high) - F.col(low), F.lit(1e-9)) * side), side - 1)
    return (stops.join(box, KEYS).withColumn("tile", at("lat", "_s", "_t") * side + at("lon", "_w", "_e"))
            .select(*KEYS, "tile", "stop_id", "stop_name", "lat", "lon", "demand"))


def _index(open_: DataFrame) -> DataFrame:
    """One row a tile: its circle, smallest demand and number of open stops."""
    cell = [*KEYS, "tile"]
    middle = open_.groupBy(*cell).agg(((F.min("lat") + F.max("lat")) / 2).alias("t_lat"),
                                      ((F.min("lon") + F.max("lon")) / 2).alias("t_lon"))
    return (open_.join(middle, cell).groupBy(*cell, "t_lat", "t_lon").agg(
        (F.max(haversine_km("t_lat", "t_lon", "lat", "lon")) + MARGIN_KM).alias("t_rad"),
        F.min("demand").alias("least"), F.count("*").alias("n")))


def _picked(state: DataFrame, index: DataFrame, capacity: float, window: int) -> DataFrame:
    """Tiles that the window of each group reads, with the group's state and reach.

    The reach is the smallest ring around the vehicle whose whole tiles fill a window;
    a group whose last window did not bring a step reads every tile that may fit.
    """
    km = haversine_km("c_lat", "c_lon", "t_lat", "t_lon")
    near = (state.join(index, KEYS).where((F.col("n") > 0) & (F.col("load") + F.col("least") <= capacity))
            .withColumns({"_low": km - F.col("t_rad"), "_high": km + F.col("t_rad")}))
    # rings grow by an eighth; only their totals are summed up in order
    ring = F.ceil(F.log(F.greatest(F.col("_high"), F.lit(1e-3))) / np.log(1.125)).cast("int")
    rings = near.withColumn("_ring", ring).groupBy(*KEYS, "_ring").agg(F.sum("n").alias("_n"))
    upto = Window.partitionBy(*KEYS).orderBy("_ring").rowsBetween(Window.unboundedPreceding, 0)
    enough = (rings.withColumn("_sum", F.sum("_n").over(upto)).where(F.col("_sum") >= window)
              .groupBy(*KEYS).agg(F.pow(F.lit(1.125), F.min("_ring")).alias("_r")))
    reach = F.when(~F.col("stuck"), F.col("_r"))
    tiles = (near.join(enough, KEYS, "left").withColumn("reach", reach)
             .where(F.col("reach").isNull() | (F.col("_low") <= F.col("reach"))).select(*KEYS, "tile"))
    heads = state.join(enough, KEYS, "left").withColumn("reach", reach).drop("_r")
    return heads.join(tiles, KEYS, "left")


def _leased(picked: DataFrame, stops: DataFrame, capacity: float, window: int) -> DataFrame:
    """Each group's state with the nearest stops of its tiles that fit, or with none."""
    nearest = Window.partitionBy(*KEYS).orderBy("_km", "stop_id")
    got = (picked.join(stops, [*KEYS, "tile"]).where(F.col("load") + F.col("demand") <= F.lit(capacity))
           .withColumn("_km", haversine_km("c_lat", "c_lon", "lat", "lon"))
           .withColumn("_rank", F.row_number().over(nearest)).where(F.col("_rank") <= window)
           .select(*KEYS, "tile", "stop_id", "stop_name", "lat", "lon", "demand"))
    return picked.drop("tile").distinct().join(got, KEYS, "left")


def tours_leased(tagged: DataFrame, n_vehicles: int, capacity: float, lease: int = LEASE) -> DataFrame:
    """The same tours as ``tours_local`` for groups of any size.

    Served stops of an epoch are the rows of its walks; the open stops are written
    anew, sorted by tile, when half of them are served.  Nothing but sums of the tile
    index and an "anyone left" test reaches the driver.
    """
    spark = tagged.sparkSession
    folder = os.path.join(ensure_checkpoint_dir(spark), f"tours-{uuid.uuid4().hex}")

    def written(df: DataFrame, name: str) -> DataFrame:
        path = os.path.join(folder, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def walks(epoch: str = "*") -> DataFrame:
        return spark.read.schema(step.schema).parquet(os.path.join(folder, f"walk-{epoch}-*"))

    cell = [*KEYS, "tile"]
    window = max(lease, WINDOW)
    state = written(tagged.groupBy(*KEYS).agg(
        F.first("depot_name").alias("depot_name"), F.first("depot_lat").alias("depot_lat"),
        F.first("depot_lon").alias("depot_lon")).withColumns(
        {"v": F.lit(0), "c_lat": F.col("depot_lat"), "c_lon": F.col("depot_lon"), "load": F.lit(0.0),
         "total": F.lit(0.0), "ord": F.lit(1), "stuck": F.lit(False)}), "state")
    stops, epoch, no = tagged, 0, 0
    while True:
        epoch += 1
        stops = written(_tiled(stops).repartitionByRange(*cell, "stop_id").sortWithinPartitions(*cell),
                        f"open-{epoch}")
        index = written(_index(stops), f"index-{epoch}-{no}")
        whole = left = index.agg(F.sum("n")).first()[0] or 0
        open_ = stops
        while left * 2 > whole or left == whole:
            no += 1
            picked = _picked(state, index, float(capacity), window)
            step = written(_leased(picked, open_, float(capacity), window).groupBy(*KEYS).applyInPandas(
                lambda pdf: walk(pdf, n_vehicles, capacity, lease, window), _WALK), f"walk-{epoch}-{no}")
            state = step.where("v is not null").select(*KEYS, *_STATE_NAMES)
            if state.isEmpty():
                return walks().where("Stop_Order is not null").select(*_ROUTE)
            gone = step.where("tile is not null").groupBy(*cell).agg(F.count("*").alias("_gone"))
            index = written(index.join(gone, cell, "left").withColumn(
                "n", F.col("n") - F.coalesce("_gone", F.lit(0))).drop("_gone"), f"index-{epoch}-{no}")
            left = index.agg(F.sum("n")).first()[0] or 0
            served = walks(str(epoch)).where("tile is not null").select(*cell, "stop_id")
            open_ = stops.join(served, [*cell, "stop_id"], "left_anti")
        stops = open_.drop("tile")
