"""Exact k nearest points on the sphere, as a join by cells.

``nearest`` descends two trees of cells together, one over the queries' places and
one over the points'.  A query cell meets the point cells of its own level, at first
all of a coarse grid.  Distances between the centres, less and plus both radii,
bound the distance of any query to any point of them; the k-th smallest upper bound
is the cell's reach, and only point cells whose lower bound lies within it stay.  A
query cell that meets few points, or holds one place, is done; others are split in
four, and so are their point cells.  Every query cell ends with the few points that
can be among the k nearest of a query in it, and each query is measured against
those alone.

All steps are equi-joins and aggregates; the work grows with the places of queries
and points, not with queries x points.  Points at one place are one place with its k
smallest ids and queries at one place are one, so a place that holds a third of all
rows costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroute.functions.columns import EARTH_RADIUS_KM, haversine_km
from stockroute.session import shared_table

DEPTH = 24                      # cells of the last level are about two metres wide
FIRST = 3                       # the globe is cut into 64 cells at once
FEW = 64                        # a cell is done with so many ids (or eight times k)
_MARGIN = 1e-6                  # km; far above rounding of the distances
_FAR = 3.15 * EARTH_RADIUS_KM   # no two points are as far apart


def _on_globe(lat: Column, lon: Column) -> Column:
    return (F.abs(lat) <= 90) & (F.abs(lon) < 1e6)


def _cell(value: Column, low: float, span: float) -> Column:
    """Number of the last level's row or column that holds a coordinate."""
    at = F.floor((value - low) / span * float(1 << DEPTH)).cast("long")
    return F.least(F.greatest(at, F.lit(0)), F.lit((1 << DEPTH) - 1))


def _row(lat: Column) -> Column:
    return _cell(lat, -90.0, 180.0)


def _column(lon: Column) -> Column:
    return _cell(F.pmod(lon + 180.0, F.lit(360.0)), 0.0, 360.0)


def _radius(lat: Column, lon: Column, south: Column, north: Column, east: Column) -> Column:
    """Reach of a box from its centre.  The farthest point of a box that spans
    less than half the globe is a corner, and those of both sides are as far."""
    corners = F.greatest(haversine_km(lat, lon, south, east), haversine_km(lat, lon, north, east))
    return F.when(east - lon >= 89.0, F.lit(_FAR)).otherwise(corners)


def _in_cells(places: DataFrame, lat: str, lon: str) -> DataFrame:
    return places.withColumns({"r": _row(F.col(lat)), "c": _column(F.col(lon))})


def _places(points: DataFrame, k: int, keys: Sequence[str], lat: str, lon: str, ident: str) -> DataFrame:
    """One row a place: keys, p_lat, p_lon, ids (its k smallest), their cell."""
    src = points.where(_on_globe(F.col(lat), F.col(lon))).select(
        *keys, F.col(lat).alias("p_lat"), F.col(lon).alias("p_lon"), F.col(ident).alias("id"))
    first = Window.partitionBy(*keys, "p_lat", "p_lon").orderBy("id")
    few = src.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return _in_cells(few.groupBy(*keys, "p_lat", "p_lon").agg(F.sort_array(F.collect_list("id")).alias("ids")),
                     "p_lat", "p_lon")


def _nodes(places: DataFrame, keys: Sequence[str], level: int, lat: str, lon: str, p: str, n: Column) -> DataFrame:
    """Cells of a level that hold places, as columns pr, pc, p_n, p_mid, p_len, p_rad
    (p: the prefix): row and column, sum of n, centre and radius."""
    shift = DEPTH - level
    east = F.pmod(F.col(lon) + 180.0, F.lit(360.0)) - 180.0
    box = (places.groupBy(*keys, F.shiftright("r", shift).alias(f"{p}r"), F.shiftright("c", shift).alias(f"{p}c"))
           .agg(F.sum(n).alias(f"{p}_n"), F.min(lat).alias("south"), F.max(lat).alias("north"),
                F.min(east).alias("west"), F.max(east).alias("east")))
    mid, length = (F.col("south") + F.col("north")) / 2, (F.col("west") + F.col("east")) / 2
    return box.select(*keys, f"{p}r", f"{p}c", f"{p}_n", mid.alias(f"{p}_mid"), length.alias(f"{p}_len"),
                      _radius(mid, length, F.col("south"), F.col("north"), F.col("east")).alias(f"{p}_rad"))


def _within_reach(pairs: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Pairs of a query cell and a point cell that may hold one of the k nearest, and the
    ids that the query cell still meets (``total``)."""
    middle = haversine_km("q_mid", "q_len", "n_mid", "n_len")
    both = F.col("q_rad") + F.col("n_rad") + _MARGIN
    cell = [*keys, "qr", "qc"]
    by_far = Window.partitionBy(*cell).orderBy("far").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*cell)
    return (pairs.withColumns({"near": middle - both, "far": middle + both})
            .withColumn("so_far", F.sum("n_n").over(by_far))
            .withColumn("reach", F.min(F.when(F.col("so_far") >= k, F.col("far"))).over(whole))
            .where(F.col("reach").isNull() | (F.col("near") <= F.col("reach")))
            .withColumn("total", F.sum("n_n").over(whole))
            .select(*cell, "nr", "nc", "total", (F.col("q_rad") < _MARGIN).alias("one")))


def _cells(places: DataFrame, spots: DataFrame, keys: Sequence[str], k: int, few: int) -> tuple[DataFrame, list[int]]:
    """Query cells with the places they need: keys, level, qr, qc, near; and the levels in use."""
    def nodes(level: int) -> DataFrame:
        return _nodes(places, keys, level, "p_lat", "p_lon", "n", F.size("ids"))

    def asks(level: int) -> DataFrame:
        return _nodes(spots, keys, level, "q_lat", "q_lon", "q", F.lit(1))

    rows = F.transform(F.sequence(F.lit(0), F.lit((1 << FIRST) - 1)), lambda x: x.cast("long"))
    start = asks(FIRST).withColumn("nr", F.explode(rows)).join(nodes(FIRST), [*keys, "nr"])
    met = shared_table(_within_reach(start, keys, k), "nearest-cells")
    parts, levels = [], []
    for level in range(FIRST, DEPTH + 1):
        open_ = (F.col("total") > few) & ~F.col("one") & F.lit(level < DEPTH)
        shift = DEPTH - level
        inside = places.withColumns({"nr": F.shiftright("r", shift), "nc": F.shiftright("c", shift)})
        done = met.where(~open_).join(inside, [*keys, "nr", "nc"])
        parts.append(done.groupBy(*keys, F.lit(level).alias("level"), "qr", "qc").agg(
            F.collect_list(F.struct("p_lat", "p_lon", "ids")).alias("near")))
        levels.append(level)
        if met.where(open_).isEmpty():
            break
        up = lambda df, p: df.withColumns({f"_{p}r": F.shiftright(f"{p}r", 1), f"_{p}c": F.shiftright(f"{p}c", 1)})
        split = (met.where(open_).select(*keys, *[F.col(c).alias(f"_{c}") for c in ("qr", "qc", "nr", "nc")])
                 .join(up(asks(level + 1), "q"), [*keys, "_qr", "_qc"])
                 .join(up(nodes(level + 1), "n"), [*keys, "_nr", "_nc"]))
        met = shared_table(_within_reach(split, keys, k), "nearest-cells")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return shared_table(out, "nearest-candidates"), levels


def nearest(queries: DataFrame, points: DataFrame, k: int, keys: Sequence[str] = (), lat: str = "lat",
            lon: str = "lon", point_lat: str = "lat", point_lon: str = "lon", ident: str = "id",
            few: int | None = None) -> DataFrame:
    """``queries`` plus ``near``: the k nearest points of the same ``keys`` as an array of
    (km, id, place), ordered by distance, then id; points as far as the k-th are kept too.

    ``place`` is the smallest id at the point's place; of one place at most k ids are
    given.  ``near`` is null where the keys have no point or a coordinate is missing, not
    a number or off the globe (latitudes beyond 90 degrees; longitudes wrap around).
    Further columns of ``queries`` are kept, ``near`` must not be one of them.
    """
    few = max(FEW, 8 * k) if few is None else few
    keys = list(keys)
    places = _places(points, k, keys, point_lat, point_lon, ident)
    most = places.groupBy(*keys).agg(F.sum(F.size("ids")).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= few:
        # the globe is one cell: its places travel as one value (a row for each key)
        near = F.collect_list(F.struct("p_lat", "p_lon", "ids")).alias("_places")
        if keys:
            found = queries.join(places.groupBy(*keys).agg(near), keys, "left")
        else:
            found = queries.withColumn("_places", places.agg(near).scalar())
    else:
        spots = _in_cells(queries.select(*keys, F.col(lat).alias("q_lat"), F.col(lon).alias("q_lon")).where(
            _on_globe(F.col("q_lat"), F.col("q_lon"))).distinct(), "q_lat", "q_lon")
        spots = shared_table(spots, "query-places")
        cells, levels = _cells(shared_table(places, "places"), spots, keys, k, few)
        # a place is in one of the cells, so its cells of other levels find nothing
        at = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright("r", DEPTH - n).alias("qr"),
                                F.shiftright("c", DEPTH - n).alias("qc")) for n in levels])
        met = (spots.withColumn("at", F.explode(at)).select(*keys, "q_lat", "q_lon", "at.*")
               .join(cells.withColumnRenamed("near", "_places"), [*keys, "level", "qr", "qc"]))
        same = (F.col(lat) == F.col("q_lat")) & (F.col(lon) == F.col("q_lon"))
        met = met.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "q_lat", "q_lon", "_places")
        for i, c in enumerate(keys):
            same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
        found = queries.join(met, same, "left").drop("q_lat", "q_lon", *[f"_k{i}" for i in range(len(keys))])
    measured = F.flatten(F.transform("_places", lambda p: F.transform(
        p["ids"], lambda i: F.struct(haversine_km(F.col(lat), F.col(lon), p["p_lat"], p["p_lon"]).alias("km"),
                                     i.alias("id"), F.get(p["ids"], 0).alias("place")))))
    ordered = F.when(_on_globe(F.col(lat), F.col(lon)) & (F.size("_places") > 0), F.array_sort(measured))
    last = F.get(F.col("near"), F.least(F.size("near"), F.lit(k)) - 1)["km"]
    return (found.withColumn("near", ordered).drop("_places")
            .withColumn("near", F.filter("near", lambda x: x["km"] <= last)))
