"""Routing (K1-K11): nearest-depot assignment, neighbour lists, naive round trips
and capacity-limited nearest-neighbour tours, keyed by (plan_id, depot).

* Nearest depots and nearest stops are exact k-nearest joins by cells
  (``nearest``), for any number of depots and stops.
* Tours are sequential inside one (plan, depot) group.  Groups up to
  ``local_group_limit`` stops are solved by ``applyInPandas``; larger groups walk
  the same greedy rule through leases of the stops around each vehicle
  (``tours``), so no task ever holds a hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroute.config import RoutingParams
from stockroute.functions.columns import haversine_km, vehicle_id
from stockroute.operators.nearest import nearest
from stockroute.operators.tours import tours_leased, tours_local


def depot_distances(stops: DataFrame, depots: DataFrame, few: int | None = None) -> DataFrame:
    """The nearest depot of every stop (ties -> lowest index), its
    distance, that of the runner-up (null with one depot), and ``depot_km``, the
    (km, id, place) of all depots as near as the runner-up in that order.

    One path for any number of depots (``nearest.nearest``): cells of the map are
    split until each has few candidate depots, so a stop measures those alone; up to
    ``few`` depots the whole map is one cell and the depots travel as one value.
    Depots at one place share ``place`` (their lowest index), at most two are listed.
    """
    found = nearest(stops, depots, 2, point_lat="depot_lat", point_lon="depot_lon", ident="depot_idx", few=few)
    return found.withColumnRenamed("near", "depot_km").withColumns({
        "depot_idx": F.get(F.col("depot_km"), 0)["id"],
        "depot_dist": F.get(F.col("depot_km"), 0)["km"],
        "second_dist": F.get(F.col("depot_km"), 1)["km"],
    })


def nearest_depot(stops: DataFrame, depots: DataFrame, few: int | None = None) -> DataFrame:
    """K2: nearest depot per stop for any depot-table size (exact)."""
    return depot_distances(stops, depots, few).drop("depot_km")


def stop_neighbours(stops: DataFrame, k: int = 5, few: int | None = None) -> DataFrame:
    """The ``k`` nearest other stops of every stop in its plan, as rows
    (plan_id, stop_id, rank from 1, neighbour_id, km); ties go to the lower id.

    Stands in for the all-pairs matrix: output grows with the stops, not with
    their square.  A stop of a plan with fewer others has fewer rows.
    """
    ids = stops.select("plan_id", F.col("stop_id").alias("id"), "lat", "lon")
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    met = nearest(ids, ids, k + 1, ["plan_id"], few=few).select("plan_id", F.col("id").alias("stop_id"),
                                                                F.posexplode(others))
    return met.select("plan_id", "stop_id", (F.col("pos") + 1).alias("rank"),
                      F.col("col.id").alias("neighbour_id"), F.col("col.km").alias("km"))


def naive_distance(assigned: DataFrame, by=("plan_id",)) -> DataFrame:
    """K9: every stop served by its own round trip from the nearest depot."""
    return assigned.groupBy(*by).agg((F.sum(F.col("depot_dist")) * 2).alias("naive_km"),
                                     F.count("*").alias("n_stops"))


def vehicles_per_depot(num_vehicles: int, n_depots: int) -> int:
    """K3: max(1, vehicles // depots)."""
    return max(1, num_vehicles // max(n_depots, 1))


def solve_routes(stops: DataFrame, depots: DataFrame,
                 p: RoutingParams = RoutingParams()) -> DataFrame:
    """K6: nearest-depot assignment then tours per (plan, depot) group.

    Output rows follow ROUTE_SCHEMA (depot row, stops, return row per vehicle).
    """
    n_depots = depots.count()
    nv = vehicles_per_depot(p.num_vehicles, n_depots)
    assigned = nearest_depot(stops, depots)
    tagged = assigned.join(depots.select("depot_idx", "depot_name", "depot_lat", "depot_lon"), "depot_idx")
    sizes = tagged.groupBy("plan_id", "depot_idx").count()
    hot = sizes.where(F.col("count") > p.local_group_limit).select("plan_id", "depot_idx")
    if hot.isEmpty():
        return tours_local(tagged, nv, p.capacity)
    small = tagged.join(hot, ["plan_id", "depot_idx"], "left_anti")
    big = tagged.join(hot, ["plan_id", "depot_idx"], "left_semi")
    return tours_local(small, nv, p.capacity).unionByName(tours_leased(big, nv, p.capacity, p.lease))


ROUTE_BLOCK = 65_536        # consecutive stops of a route that one task orders
ROUTE_KEYS = ["plan_id", "Vehicle"]


def _blocks(routes: DataFrame, block: int):
    """Routes with the block of each stop, and the window over a block."""
    from pyspark.sql import Window
    rows = routes.withColumn("_block", F.floor(F.col("Stop_Order") / block))
    return rows, Window.partitionBy(*ROUTE_KEYS, "_block").orderBy("Stop_Order")


def route_legs_audit(routes: DataFrame, block: int = ROUTE_BLOCK) -> DataFrame:
    """Leg distance recomputed from the previous stop of the vehicle; a block's
    first stop takes the last one of the block before."""
    rows, w = _blocks(routes, block)
    ends = rows.groupBy(*ROUTE_KEYS, (F.col("_block") + 1).alias("_block")).agg(
        F.max_by(F.struct("Lat", "Lon"), "Stop_Order").alias("_end"))
    back = F.when(F.row_number().over(w) == 1, F.col("_end")).otherwise(F.lag(F.struct("Lat", "Lon")).over(w))
    return (rows.join(ends, [*ROUTE_KEYS, "_block"], "left").withColumn("_back", back)
            .withColumn("leg_check", F.coalesce(haversine_km(F.col("_back.Lat"), F.col("_back.Lon"),
                                                             F.col("Lat"), F.col("Lon")), F.lit(0.0)))
            .select(*routes.columns, "leg_check"))


def running_totals(routes: DataFrame, block: int = ROUTE_BLOCK) -> DataFrame:
    """Cumulative load and distance along each route from the legs, in two levels:
    sums of whole blocks before a stop's own, and the stops of its block up to it."""
    from pyspark.sql import Window
    rows, w = _blocks(routes, block)
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    upto = Window.partitionBy(*ROUTE_KEYS).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*ROUTE_KEYS, "_block").agg(F.sum("Demand").alias("_load"), F.sum("Distance_km").alias("_km"))
    before = before.select(*ROUTE_KEYS, "_block", *[F.coalesce(F.sum(c).over(upto), F.lit(0.0)).alias(c)
                                                    for c in ("_load", "_km")])
    return (rows.join(before, [*ROUTE_KEYS, "_block"])
            .withColumns({"load_check": F.col("_load") + F.sum("Demand").over(w),
                          "distance_check": F.col("_km") + F.sum("Distance_km").over(w)})
            .select(*routes.columns, "load_check", "distance_check"))


def route_summary(routes: DataFrame) -> DataFrame:
    """One row per vehicle: depot, distance, load, stops served."""
    return routes.groupBy("plan_id", "depot_idx", "Vehicle").agg(
        F.max("Stop_Order").alias("max_stop_order"),
        F.max("Cumulative_Distance_km").alias("total_distance"),
        F.max("Cumulative_Load").alias("total_load"),
        F.count(F.when(~F.col("Is_Depot"), 1)).alias("num_stops"))


def fleet_distance(routes: DataFrame, by=("plan_id",)) -> DataFrame:
    """Max cumulative distance per vehicle, summed; legs and vehicles."""
    per_v = routes.groupBy(*by, "Vehicle").agg(
        F.max("Cumulative_Distance_km").alias("vkm"), F.sum("Distance_km").alias("legs"))
    return per_v.groupBy(*by).agg(F.sum("vkm").alias("fleet_km"),
                                  F.avg("legs").alias("avg_vehicle_km"),
                                  F.count("*").alias("vehicles_used"))


def unserved_stops(stops: DataFrame, routes: DataFrame) -> DataFrame:
    """K8/H7: stops left without a vehicle (anti join)."""
    served = routes.where(~F.col("Is_Depot")).select("plan_id", "stop_id")
    return stops.join(served, ["plan_id", "stop_id"], "left_anti")


def route_paths(routes: DataFrame) -> DataFrame:
    """Ordered path per vehicle as an array, GeoJSON and WKT text."""
    pts = F.array_sort(F.collect_list(F.struct("Stop_Order", "Lat", "Lon", "Location",
                                               "Is_Depot")))
    g = routes.groupBy("plan_id", "depot_idx", "Vehicle").agg(pts.alias("path"))
    coords = F.transform("path", lambda s: F.array(s["Lon"], s["Lat"]))
    geo = F.to_json(F.struct(F.lit("Feature").alias("type"),
                             F.struct(F.lit("LineString").alias("type"),
                                      coords.alias("coordinates")).alias("geometry"),
                             F.struct(F.col("Vehicle").alias("vehicle")).alias("properties")))
    wkt = F.concat(F.lit("LINESTRING("), F.array_join(F.transform(
        "path", lambda s: F.format_string("%.4f %.4f", s["Lon"], s["Lat"])), ", "), F.lit(")"))
    return g.withColumn("n_points", F.size("path")).withColumn("geojson", geo) \
            .withColumn("wkt", wkt)


def distance_savings(naive: Column, fleet: Column) -> dict[str, Column]:
    """Saved km and percent (guarded)."""
    sv = naive - fleet
    return {"saved_km": sv,
            "saved_pct": F.when(naive > 0, sv / naive * 100).otherwise(F.lit(0.0)),
            "saved_km_non_negative": F.greatest(F.lit(0.0), sv)}


__all__ = ["depot_distances", "nearest_depot", "stop_neighbours", "naive_distance",
           "vehicles_per_depot", "solve_routes", "route_summary", "fleet_distance",
           "unserved_stops", "route_paths", "distance_savings", "route_legs_audit",
           "running_totals", "vehicle_id"]
