"""Registered queries: one Spark plan per operator family, each with an
independent DuckDB statement over the same tables.

Every query reads whole tables from ``sf_dir``; nothing is sampled or capped.
Doubles are rounded in the final projection on both sides (``ROUND``) so the
two engines' different summation orders do not show up in value hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroute.plans import sqlviews as V
from stockroute.session import ensure_checkpoint_dir, shared_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Presentation rounding shared by both engines.  Averages of money values are
# often exact decimal ties (x.xxxxxx5); two engines that differ in the last
# bit would round such a tie apart.  Nudging by a small odd fraction of the
# last kept digit (far above float noise, far below the digit) makes ties
# round the same way everywhere.
NUDGE = 0.0123456789


def round_col(c, digits: int = DIGITS):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.signum(c) * F.lit(NUDGE * 10.0 ** -digits), digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = DIGITS, **per_col: int) -> DataFrame:
    """Round every double column (final presentation step)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_col(f.name, per_col.get(f.name, digits)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def rnd(expr: str, digits: int = DIGITS) -> str:
    return f"(round(({expr}) + sign({expr}) * {NUDGE * 10.0 ** -digits!r}, {digits}) + 0.0)"


def r(expr: str, alias: str | None = None, digits: int = DIGITS) -> str:
    return f"{rnd(expr, digits)} AS {alias or expr}"


HISTORY_COLS = ["Store", "Dept", "Date", "Weekly_Sales", "IsHoliday", "Type", "Size",
                "Temperature", "Fuel_Price", "MarkDown1", "MarkDown2", "MarkDown3",
                "MarkDown4", "MarkDown5", "CPI", "Unemployment", "Year", "Month", "Week",
                "DayOfYear", "Quarter", "Latitude", "Longitude", "Type_encoded"]
DOUBLE_HISTORY = {"Weekly_Sales", "Temperature", "Fuel_Price", "MarkDown1", "MarkDown2",
                  "MarkDown3", "MarkDown4", "MarkDown5", "CPI", "Unemployment",
                  "Latitude", "Longitude"}
LAG_COLS = ["Sales_Lag_1", "Sales_Lag_2", "Sales_Lag_4", "Sales_Lag_8", "Sales_Lag_12",
            "Sales_RollingMean_4", "Sales_RollingMean_12", "Sales_RollingStd_4"]


def _sel(cols, doubles) -> str:
    return ", ".join(r(c) if c in doubles else c for c in cols)


# ---------------------------------------------------------------- history
_SHARED: dict = {}


def shared(spark: SparkSession, key: tuple, build):
    """A prepared table reused by several queries of one session.

    It is written once as Parquet below the folder named by
    ``spark.checkpoint.dir``: later queries scan the columns they need of that
    copy, and a lost executor does not force it to be recomputed.  ``forget``
    drops the handles.
    """
    k = (spark.sparkContext.applicationId,) + key
    if k not in _SHARED:
        ensure_checkpoint_dir(spark)
        _SHARED[k] = build()
    return _SHARED[k]


def forget() -> None:
    """Drop the prepared tables and models of this process."""
    _SHARED.clear()
    _MODEL_CACHE.clear()


def _prepared_history(spark: SparkSession, sf_dir: str, type_default):
    from pyspark import StorageLevel
    from stockroute.operators.features import IMPUTED, impute_median, join_history
    from stockroute.sources import testdata as TD
    from stockroute.sources.schemas import store_coordinates
    joined = join_history(TD.sales_panel(spark, sf_dir), TD.stores_dim(spark, sf_dir),
                          TD.features_table(spark, sf_dir), store_coordinates(spark),
                          type_default).persist(StorageLevel.MEMORY_AND_DISK)
    try:   # median passes and the checkpoint write share the persisted join
        return shared_table(impute_median(joined, IMPUTED), "history")
    finally:
        joined.unpersist()


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, ("history", sf_dir), lambda: _prepared_history(spark, sf_dir, None))


# Type_encoded is null for unmapped store types; it is presented as DOUBLE on
# both sides so a nullable integer is not compared across differing
# integer-with-null conventions of the two engines' client libraries.
@register("I1_prepare_history",
          V.with_views("merged") + "\nSELECT "
          + _sel(HISTORY_COLS[:-1], DOUBLE_HISTORY)
          + ", CAST(Type_encoded AS DOUBLE) AS Type_encoded FROM history")
def q_prepare_history(spark, sf_dir):
    return rounded(history(spark, sf_dir).select(
        *HISTORY_COLS[:-1], F.col("Type_encoded").cast("double").alias("Type_encoded")))


SCORING_SQL = (V.with_views("merged").replace(
    "merged0 AS (\n  SELECT s.Store, s.Dept, s.Date, s.Weekly_Sales, s.IsHoliday,",
    "scoring AS (SELECT Store, Dept, Date, IsHoliday FROM sales\n"
    "            WHERE Date > (SELECT max(Date) FROM sales) - INTERVAL 91 DAY),\n"
    "merged0 AS (\n  SELECT s.Store, s.Dept, s.Date, s.IsHoliday,")
    .replace("FROM sales s LEFT JOIN stores st", "FROM scoring s LEFT JOIN stores st")
    .replace("SELECT m.Store, m.Dept, m.Date, m.Weekly_Sales, CAST(m.IsHoliday AS INTEGER)",
             "SELECT m.Store, m.Dept, m.Date, CAST(m.IsHoliday AS INTEGER)"))
SCORING_COLS = [c for c in HISTORY_COLS if c != "Weekly_Sales"]


@register("I2_prepare_scoring_set", SCORING_SQL + "\nSELECT "
          + _sel(SCORING_COLS[:-1], DOUBLE_HISTORY)
          + ", CAST(Type_encoded AS DOUBLE) AS Type_encoded FROM history")
def q_prepare_scoring(spark, sf_dir):
    """The scoring table (last 13 weeks, no target) prepared like the
    history, imputed with its own medians."""
    from stockroute.operators.features import prepare_history
    from stockroute.sources import testdata as TD
    from stockroute.sources.schemas import store_coordinates
    panel = TD.sales_panel(spark, sf_dir)
    cutoff = F.date_sub(panel.agg(F.max("Date")).scalar(), 91)
    scoring = panel.where(F.col("Date") > cutoff).drop("Weekly_Sales")
    out = prepare_history(scoring, TD.stores_dim(spark, sf_dir), TD.features_table(spark, sf_dir),
                          store_coordinates(spark))
    return rounded(out.select(*SCORING_COLS[:-1],
                              F.col("Type_encoded").cast("double").alias("Type_encoded")))


@register("I5_lag_features",
          V.with_views("lags") + "\nSELECT Store, Dept, Date, "
          + _sel(["Weekly_Sales"] + LAG_COLS[:-1], set(LAG_COLS) | {"Weekly_Sales"})
          + ", " + r("Sales_RollingStd_4", digits=4) + " FROM lagged")
def q_lag_features(spark, sf_dir):
    from stockroute.operators.features import lag_features
    return rounded(lag_features(history(spark, sf_dir))
                   .select("Store", "Dept", "Date", "Weekly_Sales", *LAG_COLS),
                   Sales_RollingStd_4=4)


def lagged(spark, sf_dir):
    """Lagged complete rows with their split, written once (the windows run once)."""
    from stockroute.operators.features import lag_features, model_rows, time_split
    return shared(spark, ("lagged", sf_dir), lambda: shared_table(time_split(shared_table(
        model_rows(lag_features(history(spark, sf_dir))), "lagged")), "split"))


SPLIT_SQL = """
model AS (SELECT * FROM lagged WHERE Sales_Lag_1 IS NOT NULL AND Sales_Lag_2 IS NOT NULL
          AND Sales_Lag_4 IS NOT NULL AND Sales_Lag_8 IS NOT NULL AND Sales_Lag_12 IS NOT NULL
          AND Sales_RollingMean_4 IS NOT NULL AND Sales_RollingMean_12 IS NOT NULL
          AND Sales_RollingStd_4 IS NOT NULL),
split AS (SELECT *, CASE WHEN Date <= (SELECT max(Date) FROM model) - INTERVAL 91 DAY
                         THEN 'train' ELSE 'val' END AS split FROM model)"""


@register("I6_time_split",
          V.with_views("lags") + "," + SPLIT_SQL
          + "\nSELECT split, count(*) AS n_rows, min(Date) AS first_date, max(Date) AS last_date,"
          " count(DISTINCT Store) AS n_stores FROM split GROUP BY split")
def q_time_split(spark, sf_dir):
    df = lagged(spark, sf_dir)
    return df.groupBy("split").agg(F.count("*").alias("n_rows"), F.min("Date").alias("first_date"),
                                   F.max("Date").alias("last_date"),
                                   F.count_distinct("Store").alias("n_stores"))


@register("F16_forecast_metrics",
          V.with_views("lags") + "," + SPLIT_SQL + """
SELECT Store, n, """ + r("mae", digits=4) + ", " + r("rmse", digits=4) + ", "
          + r("r2", digits=4) + """ FROM (
  SELECT Store, count(*) AS n, avg(abs(Weekly_Sales - Sales_RollingMean_4)) AS mae,
       sqrt(avg((Weekly_Sales - Sales_RollingMean_4) * (Weekly_Sales - Sales_RollingMean_4))) AS rmse,
       1 - sum((Weekly_Sales - Sales_RollingMean_4) * (Weekly_Sales - Sales_RollingMean_4))
             / (count(*) * var_pop(Weekly_Sales)) AS r2
  FROM split WHERE split = 'val' GROUP BY Store) t""")
def q_forecast_metrics(spark, sf_dir):
    """Flagship: per-store MAE / RMSE / R^2 of the 4-week moving-average
    forecast over the 13 validation weeks."""
    from stockroute.operators.aggregates import regression_metrics
    val = lagged(spark, sf_dir).where(F.col("split") == "val")
    return rounded(regression_metrics(val, "Weekly_Sales", "Sales_RollingMean_4", by=["Store"]),
                   digits=4)


# ---------------------------------------------------------------- inventory
def _params():
    from stockroute.config import PlanningParams
    return PlanningParams()


def ma_predictions(spark, sf_dir) -> DataFrame:
    """Deterministic forecast used by the planning queries: the 4-week moving
    average over the 13 validation weeks (no model, oracle-checkable)."""
    val = lagged(spark, sf_dir).where(F.col("split") == "val")
    return val.select("Store", "Dept", "Date",
                      F.col("Sales_RollingMean_4").alias("Predicted_Weekly_Sales"))


def demand_series_q(spark, sf_dir):
    from stockroute.operators.inventory import demand_series, store_week_demand
    return demand_series(store_week_demand(ma_predictions(spark, sf_dir)), _params().inventory)


PRED_SQL = """
pred AS (SELECT Store, Dept, Date, Sales_RollingMean_4 AS p FROM split WHERE split = 'val'),
sd AS (SELECT Store, Date, sum(p) AS d FROM pred GROUP BY Store, Date),
ser AS (SELECT Store, Date, d,
               CAST(row_number() OVER (PARTITION BY Store ORDER BY Date) AS INTEGER) AS t,
               count(*) OVER (PARTITION BY Store) AS nT,
               avg(d) OVER (PARTITION BY Store) AS ss FROM sd),
ser2 AS (SELECT *, sum(d) OVER (PARTITION BY Store ORDER BY t ROWS UNBOUNDED PRECEDING) AS cum
         FROM ser WHERE nT >= 2),
ser3 AS (SELECT *, max(cum) OVER (PARTITION BY Store ORDER BY t ROWS UNBOUNDED PRECEDING) AS cmax
         FROM ser2)"""

INV_BASE = V.with_views("lags") + "," + SPLIT_SQL + "," + PRED_SQL


@register("F1_store_week_demand",
          INV_BASE + "\nSELECT Store, Date, " + r("d", "Total_Demand") + " FROM sd")
def q_store_week_demand(spark, sf_dir):
    from stockroute.operators.inventory import store_week_demand
    return rounded(store_week_demand(ma_predictions(spark, sf_dir)))


@register("J3_order_up_to_plan", INV_BASE + """,
up AS (SELECT Store, t AS Week, d AS Demand, ss,
              greatest(1.5 * ss, ss + cmax) - cum AS lvl FROM ser3),
up2 AS (SELECT *, (CASE WHEN Demand + ss - coalesce(lag(lvl) OVER (PARTITION BY Store ORDER BY Week), 1.5 * ss) > 1e-9 * greatest(1.0, abs(ss)) THEN Demand + ss - coalesce(lag(lvl) OVER (PARTITION BY Store ORDER BY Week), 1.5 * ss) ELSE 0.0 END) AS ord FROM up)
SELECT Store, Week, """ + ", ".join([r("Demand"), r("ord", "Optimal_Order"), r("lvl", "Inventory_Level"),
                                     r("0.05 * lvl", "Holding_Cost"),
                                     r("CASE WHEN ord > 0 THEN 5000.0 ELSE 0.0 END", "Ordering_Cost"),
                                     r("0.05 * lvl + CASE WHEN ord > 0 THEN 5000.0 ELSE 0.0 END",
                                       "Total_Cost")]) + " FROM up2")
def q_order_up_to(spark, sf_dir):
    from stockroute.operators.inventory import order_up_to, plan_rows
    p = _params().inventory
    return rounded(plan_rows(order_up_to(demand_series_q(spark, sf_dir)), p, order_threshold=0.0))


@register("J2_lot_sizing_cost", INV_BASE + """,
ser4 AS (SELECT *, greatest(cmax - 0.5 * ss, 0.0) AS req FROM ser3),
ser5 AS (SELECT *, req - coalesce(lag(req) OVER (PARTITION BY Store ORDER BY t), 0.0) AS net FROM ser4),
masks AS (SELECT Store, unnest(range(0, CAST(1 AS BIGINT) << CAST(nT AS BIGINT))) AS m
          FROM (SELECT DISTINCT Store, nT FROM ser5) x),
blk AS (SELECT s.Store, k.m, s.t, s.net, s.req, s.cum, s.ss,
               max(CASE WHEN (k.m >> (s.t - 1)) & 1 = 1 THEN s.t ELSE 0 END)
                 OVER (PARTITION BY s.Store, k.m ORDER BY s.t ROWS UNBOUNDED PRECEDING) AS b
        FROM ser5 s JOIN masks k ON s.Store = k.Store),
blk2 AS (SELECT *, sum(net) OVER (PARTITION BY Store, m, b) AS blockq,
                sum(net) OVER (PARTITION BY Store, m, b ORDER BY t ROWS UNBOUNDED PRECEDING) AS cumq
         FROM blk),
cost AS (SELECT Store, m, bool_and(NOT (b = 0 AND net > 0)) AS feasible,
                sum(CASE WHEN b > 0 THEN blockq - cumq ELSE 0.0 END) AS hold_r,
                count(DISTINCT CASE WHEN b > 0 AND blockq > 0 THEN b END) AS n_orders,
                sum(1.5 * ss + req - cum) AS hold_c
         FROM blk2 GROUP BY Store, m)
SELECT Store, """ + r("min(5000.0 * n_orders + 0.05 * (hold_r + hold_c))", "plan_cost", 2) + """
FROM cost WHERE feasible GROUP BY Store""")
def q_lot_sizing_cost(spark, sf_dir):
    """J2 checked against brute-force enumeration of all order-week sets."""
    from stockroute.operators.inventory import lot_size
    planned = lot_size(demand_series_q(spark, sf_dir), _params().inventory)
    return planned.select("Store", round_col("plan_cost", 2).alias("plan_cost"))


J5_SQL = INV_BASE + """,""" + """
ser4 AS (SELECT *, greatest(cmax - 0.5 * ss, 0.0) AS req FROM ser3),
ser5 AS (SELECT *, req - coalesce(lag(req) OVER (PARTITION BY Store ORDER BY t), 0.0) AS net FROM ser4),
masks AS (SELECT Store, unnest(range(0, CAST(1 AS BIGINT) << CAST(nT AS BIGINT))) AS m
          FROM (SELECT DISTINCT Store, nT FROM ser5) x),
blk AS (SELECT s.Store, k.m, s.t, s.net, s.req, s.cum, s.ss, s.d,
               max(CASE WHEN (k.m >> (s.t - 1)) & 1 = 1 THEN s.t ELSE 0 END)
                 OVER (PARTITION BY s.Store, k.m ORDER BY s.t ROWS UNBOUNDED PRECEDING) AS b
        FROM ser5 s JOIN masks k ON s.Store = k.Store),
blk2 AS (SELECT *, sum(net) OVER (PARTITION BY Store, m, b) AS blockq,
                sum(net) OVER (PARTITION BY Store, m, b ORDER BY t ROWS UNBOUNDED PRECEDING) AS cumq
         FROM blk),
cost AS (SELECT Store, m, bool_and(NOT (b = 0 AND net > 0)) AS feasible,
                sum(CASE WHEN b > 0 THEN blockq - cumq ELSE 0.0 END) AS hold_r,
                count(DISTINCT CASE WHEN b > 0 AND blockq > 0 THEN b END) AS n_orders,
                sum(1.5 * ss + req - cum) AS hold_c
         FROM blk2 GROUP BY Store, m),
best AS (SELECT Store, min_by(m, 5000.0 * n_orders + 0.05 * (hold_r + hold_c)) AS m
         FROM cost WHERE feasible GROUP BY Store),
pl AS (SELECT b.Store, b.t AS Week, b.d AS Demand,
              CASE WHEN b.b = b.t AND b.blockq > 0 THEN b.blockq ELSE 0.0 END AS ord, b.cum, b.ss
       FROM blk2 b JOIN best x ON b.Store = x.Store AND b.m = x.m),
pl2 AS (SELECT *, 1.5 * ss + sum(ord) OVER (PARTITION BY Store ORDER BY Week
                                            ROWS UNBOUNDED PRECEDING) - cum AS lvl FROM pl)
SELECT Store, Week, """ + ", ".join([
    r("Demand", digits=2), r("ord", "Optimal_Order", 2), r("lvl", "Inventory_Level", 2),
    r("0.05 * lvl", "Holding_Cost", 2),
    r("CASE WHEN ord > 0.01 THEN CAST(5000 AS DOUBLE) ELSE 0.0 END", "Ordering_Cost", 2),
    r("0.05 * lvl + CASE WHEN ord > 0.01 THEN CAST(5000 AS DOUBLE) ELSE 0.0 END", "Total_Cost", 2)]) + ", 'optimal' AS method, true AS feasible FROM pl2"


@register("J5_inventory_plan", J5_SQL)
def q_inventory_plan(spark, sf_dir):
    """Optimal plan rows, checked against the plan of the cheapest
    order-week set found by brute-force enumeration in SQL (sets that tie
    differ only by zero-quantity orders, which give identical rows)."""
    from stockroute.operators.inventory import optimise_inventory
    return rounded(optimise_inventory(ma_predictions(spark, sf_dir), _params().inventory), 2)


@register("J6_naive_cost", INV_BASE + "\nSELECT Store, "
          + r("count(*) * 5000.0 + 0.05 * (count(*) * avg(d) + 0.5 * sum(d))", "naive_cost")
          + " FROM ser3 GROUP BY Store")
def q_naive_cost(spark, sf_dir):
    from stockroute.operators.inventory import naive_cost
    return rounded(naive_cost(demand_series_q(spark, sf_dir), _params().inventory))


# ---------------------------------------------------------------- routing
def routing_inputs(spark, sf_dir):
    from stockroute.sources import testdata as TD
    return TD.routing_stops(spark, sf_dir), TD.routing_depots(spark, sf_dir)


ROUTE_BASE = "WITH " + V.ROUTING.strip()


@register("K2_nearest_depot", ROUTE_BASE + "\nSELECT plan_id, stop_id, k AS depot_idx, "
          + r("km", "depot_km", 4) + " FROM ranked WHERE rk = 1")
def q_nearest_depot(spark, sf_dir):
    from stockroute.operators.routing import nearest_depot
    stops, depots = routing_inputs(spark, sf_dir)
    a = nearest_depot(stops, depots)
    return a.select("plan_id", "stop_id", "depot_idx",
                    round_col("depot_dist", 4).alias("depot_km"))


@register("K9_naive_distance", ROUTE_BASE + "\nSELECT plan_id, " + r("2 * sum(km)", "naive_km", 4)
          + ", count(*) AS n_stops FROM ranked WHERE rk = 1 GROUP BY plan_id")
def q_naive_distance(spark, sf_dir):
    from stockroute.operators.routing import naive_distance, nearest_depot
    stops, depots = routing_inputs(spark, sf_dir)
    return rounded(naive_distance(nearest_depot(stops, depots)), 4)


def routes_q(spark, sf_dir):
    from stockroute.operators.routing import solve_routes
    stops, depots = routing_inputs(spark, sf_dir)
    return solve_routes(stops, depots, _params().routing)


TOUR_BASE = "WITH RECURSIVE " + V.ROUTING.strip() + "," + V.TOURS
ROUTE_COLS = ["plan_id", "depot_idx", "Vehicle", "Stop_Order", "stop_id", "Location", "Lat", "Lon",
              "Demand", "Cumulative_Load", "Distance_km", "Cumulative_Distance_km", "Is_Depot"]
ROUTE_DOUBLES = {"Lat", "Lon", "Demand", "Cumulative_Load", "Distance_km",
                 "Cumulative_Distance_km"}


@register("K4_routes", TOUR_BASE + "\nSELECT " + ", ".join(
    r(c, digits=4) if c in ROUTE_DOUBLES else c for c in ROUTE_COLS) + " FROM route_rows")
def q_routes(spark, sf_dir):
    """K4-K6: capacity-limited nearest-neighbour tours for every (plan, depot)."""
    return rounded(routes_q(spark, sf_dir), 4)


@register("K7_route_summary", TOUR_BASE + """
SELECT plan_id, depot_idx, Vehicle, max(Stop_Order) AS max_stop_order, """
          + r("max(Cumulative_Distance_km)", "total_distance", 4) + ", "
          + r("max(Cumulative_Load)", "total_load", 4)
          + ", count(CASE WHEN NOT Is_Depot THEN 1 END) AS num_stops FROM route_rows GROUP BY 1, 2, 3")
def q_route_summary(spark, sf_dir):
    from stockroute.operators.routing import route_summary
    return rounded(route_summary(routes_q(spark, sf_dir)), 4)


@register("F7_fleet_distance", TOUR_BASE + """,
pv AS (SELECT plan_id, Vehicle, max(Cumulative_Distance_km) AS vkm, sum(Distance_km) AS legs
       FROM route_rows GROUP BY 1, 2)
SELECT plan_id, """ + r("sum(vkm)", "fleet_km", 4) + ", " + r("avg(legs)", "avg_vehicle_km", 4)
          + ", count(*) AS vehicles_used FROM pv GROUP BY plan_id")
def q_fleet_distance(spark, sf_dir):
    from stockroute.operators.routing import fleet_distance
    return rounded(fleet_distance(routes_q(spark, sf_dir)), 4)


@register("K8_unserved_stops", TOUR_BASE + """
SELECT s.plan_id, s.stop_id, s.stop_name, """ + r("s.lat", "lat") + ", " + r("s.lon", "lon") + ", "
          + r("s.demand", "demand") + """ FROM stops s
WHERE NOT EXISTS (SELECT 1 FROM route_rows r WHERE NOT r.Is_Depot AND r.plan_id = s.plan_id
                  AND r.stop_id = s.stop_id)""")
def q_unserved(spark, sf_dir):
    from stockroute.operators.routing import unserved_stops
    stops, _ = routing_inputs(spark, sf_dir)
    return rounded(unserved_stops(stops, routes_q(spark, sf_dir)))


@register("K11_route_paths", TOUR_BASE + """
SELECT plan_id, depot_idx, Vehicle, count(*) AS n_points,
       'LINESTRING(' || string_agg(printf('%.4f %.4f', Lon, Lat), ', ' ORDER BY Stop_Order) || ')'
         AS wkt
FROM route_rows GROUP BY 1, 2, 3""")
def q_route_paths(spark, sf_dir):
    """Ordered path of every vehicle (WKT; GeoJSON is in the library)."""
    from stockroute.operators.routing import route_paths
    return route_paths(routes_q(spark, sf_dir)).select(
        "plan_id", "depot_idx", "Vehicle", F.col("n_points").cast("long").alias("n_points"), "wkt")


# ---------------------------------------------------------------- scenarios
SPIKE_FACTORS = (1.1, 1.2, 1.5)
DELAYS = (7, 14)


def fallback_plan(spark, sf_dir):
    from stockroute.operators.inventory import order_up_to, plan_rows
    return plan_rows(order_up_to(demand_series_q(spark, sf_dir)), _params().inventory,
                     order_threshold=0.0)


def optimal_plan(spark, sf_dir):
    """J5's plan: what the application's reports and scenarios are computed on."""
    from stockroute.operators.inventory import optimise_inventory
    return optimise_inventory(ma_predictions(spark, sf_dir), _params().inventory)


FALLBACK_CTES = """
up AS (SELECT Store, t AS Week, d, greatest(1.5 * ss, ss + cmax) - cum AS lvl, ss FROM ser3),
up2 AS (SELECT *, (CASE WHEN d + ss - coalesce(lag(lvl) OVER (PARTITION BY Store ORDER BY Week), 1.5 * ss) > 1e-9 * greatest(1.0, abs(ss)) THEN d + ss - coalesce(lag(lvl) OVER (PARTITION BY Store ORDER BY Week), 1.5 * ss) ELSE 0.0 END) AS ord FROM up)"""
OPTIMAL_CTES = (J5_SQL[len(INV_BASE) + 1:J5_SQL.index("\nSELECT Store, Week, ")]
                + ",\nup2 AS (SELECT Store, Week, Demand AS d, ss, lvl, ord FROM pl2)")

PLAN_SQL = INV_BASE + "," + FALLBACK_CTES + """,
bc AS (SELECT coalesce(sum(0.05 * lvl + CASE WHEN ord > 0 THEN 5000.0 ELSE 0.0 END), 0.0) AS base
       FROM up2),
ps AS (SELECT Store, avg(p) AS m, sum(p) AS sm, count(p) AS cm FROM pred GROUP BY Store)"""


def register_plans(name: str, sql: str):
    """Register a report for the optimal plan, and as ``<name>_fallback`` for the
    fallback policy's; ``sql`` is written for the latter."""
    def deco(fn):
        register(name, sql.replace(FALLBACK_CTES, OPTIMAL_CTES))(
            lambda spark, sf_dir: fn(spark, sf_dir, optimal_plan(spark, sf_dir)))
        register(name + "_fallback", sql)(
            lambda spark, sf_dir: fn(spark, sf_dir, fallback_plan(spark, sf_dir)))
        return fn
    return deco


@register_plans("F9_plan_summary", PLAN_SQL + """
SELECT """ + r("sum(0.05 * lvl + CASE WHEN ord > 0 THEN 5000.0 ELSE 0.0 END)", "total_cost", 2)
                + ", count(CASE WHEN ord > 0 THEN 1 END) AS orders_placed, "
                + r("avg(lvl)", "avg_inventory", 2) + " FROM up2")
def q_plan_summary(spark, sf_dir, plan):
    from stockroute.operators.inventory import plan_summary
    return rounded(plan_summary(plan), 2)


@register_plans("J7_savings", PLAN_SQL + """,
pc AS (SELECT sum(0.05 * lvl + CASE WHEN ord > 0 THEN 5000.0 ELSE 0.0 END) AS plan_total FROM up2),
nc AS (SELECT sum(n_cost) AS naive_total FROM (
         SELECT count(*) * 5000.0 + 0.05 * (count(*) * avg(d) + 0.5 * sum(d)) AS n_cost
         FROM ser3 GROUP BY Store) z)
SELECT """ + ", ".join([r("naive_total", digits=2), r("plan_total", digits=2),
                       r("naive_total - plan_total", "savings", 2),
                       r("CASE WHEN naive_total > 0 THEN (naive_total - plan_total) / naive_total * 100 ELSE 0 END",
                         "savings_pct", 4)]) + " FROM pc, nc")
def q_savings(spark, sf_dir, plan):
    """J7 against the naive policy."""
    from stockroute.operators.inventory import naive_cost, plan_summary, savings
    plan_total = plan_summary(plan).select(F.col("total_cost").alias("plan_total"))
    naive_total = naive_cost(demand_series_q(spark, sf_dir), _params().inventory).agg(
        F.sum("naive_cost").alias("naive_total"))
    both = naive_total.select("naive_total", plan_total.scalar().alias("plan_total"))
    sv = savings(F.col("naive_total"), F.col("plan_total"))
    return rounded(both.select("naive_total", "plan_total", sv["savings"].alias("savings"),
                               sv["savings_pct"].alias("savings_pct")), 2, savings_pct=4)


SPIKE_SQL = PLAN_SQL + """,
f AS (SELECT CAST(unnest([""" + ", ".join(str(x) for x in SPIKE_FACTORS) + """]) AS DOUBLE) AS factor),
sp AS (SELECT factor, avg(m) AS b_avg, avg(m * factor) AS n_avg, sum(m) AS sb, sum(m * factor) AS sn,
              sum(sm) / sum(cm) AS b_row, sum(sm * factor) / sum(cm) AS n_row, any_value(base) AS base
       FROM ps CROSS JOIN f CROSS JOIN bc GROUP BY factor),
sp2 AS (SELECT *, base * (sn / greatest(sb, 1.0)) * 1.1 AS new_cost FROM sp)"""


L1_SELECT = "SELECT " + ", ".join([
    r("factor", digits=4), r("b_avg", "baseline_avg_demand", 4), r("n_avg", "new_avg_demand", 4),
    r("b_row", "baseline_row_avg_demand", 4), r("n_row", "new_row_avg_demand", 4),
    r("(factor - 1) * 100", "demand_increase_pct", 4), r("base", "baseline_inventory_cost", 4),
    r("new_cost", "new_inventory_cost", 4), r("new_cost - base", "cost_increase", 4),
    r("(new_cost / greatest(base, 1.0) - 1) * 100", "cost_increase_pct", 4),
    "CAST(greatest(0, ceil((factor - 1) * 5.0)) AS INTEGER) AS additional_vehicles_needed"]) + " FROM sp2"


@register_plans("L1_demand_spike", SPIKE_SQL + "\n" + L1_SELECT)
def q_demand_spike(spark, sf_dir, plan):
    from stockroute.operators.scenarios import demand_spike
    p = _params()
    return rounded(demand_spike(ma_predictions(spark, sf_dir), plan, SPIKE_FACTORS, None, p.scenario,
                                p.routing), 4)


DELAY_SQL = PLAN_SQL + """,
pw AS (SELECT Store, avg(p) AS w FROM pred GROUP BY Store),
ml AS (SELECT Store, min(lvl) AS min_level FROM up2 GROUP BY Store),
per AS (SELECT ml.min_level, pw.w FROM ml FULL JOIN pw ON ml.Store = pw.Store),
dl AS (SELECT CAST(unnest([""" + ", ".join(str(x) for x in DELAYS) + """]) AS INTEGER) AS delay_days),
x AS (SELECT delay_days, min_level, w, coalesce(w, 0.0) / 7.0 * delay_days AS extra
      FROM per CROSS JOIN dl),
agg AS (SELECT delay_days, sum(CASE WHEN w IS NOT NULL THEN extra END) AS ext,
               count(CASE WHEN min_level < extra THEN 1 END) AS risk, count(min_level) AS nplan
        FROM x GROUP BY delay_days),
agg2 AS (SELECT agg.*, bc.base, coalesce(ext, 0.0) * 0.05 * delay_days / 7.0 AS addh
         FROM agg CROSS JOIN bc)"""


L2_SELECT = "SELECT delay_days, " + ", ".join([
    r("ext", "extra_safety_stock_total", 4), r("addh", "additional_holding_cost", 4),
    r("base", "baseline_inventory_cost", 4), r("base + addh", "new_inventory_cost", 4),
    r("(base + addh) - base", "cost_increase", 4),
    r("((base + addh) / greatest(base, 1.0) - 1) * 100", "cost_increase_pct", 4),
    "risk AS stores_at_stockout_risk",
    r("risk * 100.0 / greatest(nplan, 1)", "stockout_risk_pct", 4)]) + " FROM agg2"


@register_plans("L2_supply_delay", DELAY_SQL + "\n" + L2_SELECT)
def q_supply_delay(spark, sf_dir, plan):
    from stockroute.operators.scenarios import supply_delay
    return rounded(supply_delay(ma_predictions(spark, sf_dir), plan, DELAYS, _params().inventory), 4)


FAIL_SQL = ROUTE_BASE + """,
cases AS (SELECT p.plan_id, d.depot_idx AS failed_depot
          FROM (SELECT DISTINCT plan_id FROM stops) p CROSS JOIN depots d),
per AS (SELECT c.plan_id, c.failed_depot, x.stop_id,
               min(CASE WHEN x.k <> c.failed_depot THEN x.km END) AS min_other,
               max(CASE WHEN x.k = c.failed_depot THEN x.km END) AS d_failed,
               min(x.km) AS best
        FROM cases c JOIN sdist x ON x.plan_id = c.plan_id GROUP BY 1, 2, 3),
fl AS (SELECT plan_id, failed_depot,
              CAST(count(CASE WHEN d_failed <= min_other THEN 1 END) AS BIGINT) AS reassigned,
              2 * sum(min_other) AS new_km, 2 * sum(best) AS base_km
       FROM per GROUP BY 1, 2)"""


L3_SELECT = ("SELECT plan_id, failed_depot, reassigned AS stores_reassigned, "
             + ", ".join([r("new_km", "new_distance_km", 4), r("base_km", "baseline_distance_km", 4),
                       r("new_km - base_km", "distance_increase_km", 4),
                       r("(new_km / greatest(base_km, 1.0) - 1) * 100", "distance_increase_pct", 4),
                       r("(new_km - base_km) * 1.5", "additional_fuel_cost_estimate", 4)])
             + " FROM fl")


@register("L3_depot_failure", FAIL_SQL + "\n" + L3_SELECT)
def q_depot_failure(spark, sf_dir):
    """L3 for every depot of every plan, baseline = round trips over all depots."""
    from stockroute.operators.scenarios import depot_failure
    stops, depots = routing_inputs(spark, sf_dir)
    return rounded(depot_failure(stops, depots, None, None, _params().scenario), 4)


# ---------------------------------------------------------------- orders, profiles
def orders_q(spark, sf_dir):
    from stockroute.operators.features import prepare_orders
    from stockroute.sources import testdata as TD
    return prepare_orders(TD.retail_orders(spark, sf_dir))


RETAIL_BASE = "WITH " + V.RETAIL.strip()


@register("I4_prepare_orders", RETAIL_BASE + """
SELECT "Order ID" AS order_id, "Order Date" AS order_date, "Ship Date" AS ship_date,
       "Ship Mode" AS ship_mode, Returned_flag AS returned, City AS city, State AS state,
       Lead_Time_Days AS lead_time_days, Ship_Mode_encoded AS ship_mode_encoded, """
          + r("Latitude", "latitude", 6) + ", " + r("Longitude", "longitude", 6) + " FROM retail_clean")
def q_prepare_orders(spark, sf_dir):
    df = orders_q(spark, sf_dir)
    return rounded(df.select(
        F.col("Order ID").alias("order_id"), F.col("Order Date").alias("order_date"),
        F.col("Ship Date").alias("ship_date"), F.col("Ship Mode").alias("ship_mode"),
        F.col("Returned").alias("returned"), F.col("City").alias("city"),
        F.col("State").alias("state"), F.col("Lead_Time_Days").alias("lead_time_days"),
        F.col("Ship_Mode_encoded").alias("ship_mode_encoded"),
        F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude")))


@register("F18_lead_time_by_ship_mode", RETAIL_BASE + """
SELECT Lead_Time_Days AS lead_time_days, "Ship Mode" AS ship_mode, count(*) AS n
FROM retail_clean GROUP BY 1, 2""")
def q_lead_time_counts(spark, sf_dir):
    from stockroute.operators.aggregates import two_way_counts
    df = orders_q(spark, sf_dir).select(F.col("Lead_Time_Days").alias("lead_time_days"),
                                        F.col("Ship Mode").alias("ship_mode"))
    return two_way_counts(df, "lead_time_days", "ship_mode")


@register("F17_sales_histogram", V.with_views("panel") + """,
mm AS (SELECT min(Weekly_Sales) AS lo, max(Weekly_Sales) AS hi FROM sales),
b AS (SELECT CAST(least(floor((Weekly_Sales - lo) / ((hi - lo) / 100.0)), 99) AS INTEGER) AS bin,
             lo, hi FROM sales CROSS JOIN mm)
SELECT bin, """ + r("any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 100.0", "bin_lo", 4) + ", "
          + r("any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / 100.0", "bin_hi", 4)
          + ", count(*) AS n FROM b GROUP BY bin")
def q_sales_histogram(spark, sf_dir):
    """100 equal-width bins of weekly sales over the data range."""
    from stockroute.operators.aggregates import histogram
    from stockroute.sources import testdata as TD
    return rounded(histogram(TD.sales_panel(spark, sf_dir), "Weekly_Sales", 100), 4)


@register("B3_upload_profile", V.with_views("panel") + """
SELECT count(*) AS n_rows, count(DISTINCT Store) AS n_stores, count(DISTINCT Dept) AS n_depts,
       min(Date) AS first_date, max(Date) AS last_date FROM sales""")
def q_upload_profile(spark, sf_dir):
    """Rows, distinct stores and departments, period."""
    from stockroute.sources import testdata as TD
    from stockroute.operators.aggregates import profile
    return profile(TD.sales_panel(spark, sf_dir))


@register("F14_last_row_per_series", V.with_views("panel") + """,
lastr AS (SELECT *, row_number() OVER (PARTITION BY Store, Dept ORDER BY Date DESC) AS rk FROM sales)
SELECT Store, Dept, Date AS last_date, """ + r("Weekly_Sales", "last_sales") + """,
       CAST(count(*) OVER (PARTITION BY Store, Dept) AS BIGINT) AS n_weeks
FROM lastr QUALIFY rk = 1""")
def q_last_row(spark, sf_dir):
    """Last observation and length of every series."""
    from stockroute.sources import testdata as TD
    panel = TD.sales_panel(spark, sf_dir)
    from stockroute.operators.aggregates import last_row
    last = last_row(panel, ["Store", "Dept"], "Date", ["Date", "Weekly_Sales"])
    return rounded(last.select("Store", "Dept", F.col("Date").alias("last_date"),
                               F.col("Weekly_Sales").alias("last_sales"), "n_weeks"))


# ---------------------------------------------------------------- model forecasts
_MODEL_CACHE: dict = {}


def ml_history(spark, sf_dir):
    """History for the model path: unmapped store types coded 1 (the same
    prepared table with the runner's default; medians do not depend on it)."""
    return history(spark, sf_dir).withColumn(
        "Type_encoded", F.coalesce(F.col("Type_encoded"), F.lit(1)))


def fitted(spark, sf_dir):
    """(model, model frame); the fit is cached per session and folder."""
    from stockroute.operators.forecast import fit_model, prepare_model_frame
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODEL_CACHE:
        frame = prepare_model_frame(ml_history(spark, sf_dir), _params().forecast)
        _MODEL_CACHE[key] = (fit_model(frame, _params().forecast), frame)
    return _MODEL_CACHE[key]


@register("I9_model_metrics")
def q_model_metrics(spark, sf_dir):
    """GBT fit on the training weeks; MAE/RMSE/R^2 on train and val."""
    from stockroute.operators.forecast import evaluate
    model, frame = fitted(spark, sf_dir)
    metrics, _ = evaluate(model, frame, _params().forecast)
    return rounded(metrics, 4)


@register("I9_validation_predictions")
def q_validation(spark, sf_dir):
    from stockroute.operators.forecast import evaluate
    model, frame = fitted(spark, sf_dir)
    _, val = evaluate(model, frame, _params().forecast)
    return rounded(val, 4)


@register("I10_feature_importance")
def q_importance(spark, sf_dir):
    from stockroute.operators.forecast import feature_importance
    model, _ = fitted(spark, sf_dir)
    return rounded(feature_importance(model, _params().forecast), 6)


@register("I11_forecast_direct")
def q_forecast_direct(spark, sf_dir):
    """13-week forecast per series, lags frozen at the last week."""
    from stockroute.operators.forecast import forecast_direct
    model, _ = fitted(spark, sf_dir)
    return forecast_direct(model, ml_history(spark, sf_dir), _params().forecast)


@register("I12_forecast_recursive")
def q_forecast_recursive(spark, sf_dir):
    """13-week forecast per series, each week fed back into the lags."""
    from stockroute.operators.forecast import forecast_recursive
    model, _ = fitted(spark, sf_dir)
    return forecast_recursive(model, ml_history(spark, sf_dir), _params().forecast)


def _as_double(select_sql: str, key: str, cols: list[str]) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT {key}, {casts} FROM ({select_sql}) q"


L1_COLS = ["baseline_avg_demand", "new_avg_demand", "baseline_row_avg_demand", "new_row_avg_demand",
           "demand_increase_pct", "baseline_inventory_cost",
           "new_inventory_cost", "cost_increase", "cost_increase_pct", "additional_vehicles_needed"]
L2_COLS = ["extra_safety_stock_total", "additional_holding_cost", "baseline_inventory_cost",
           "new_inventory_cost", "cost_increase", "cost_increase_pct", "stores_at_stockout_risk",
           "stockout_risk_pct"]
L3_COLS = ["stores_reassigned", "new_distance_km", "baseline_distance_km", "distance_increase_km",
           "distance_increase_pct", "additional_fuel_cost_estimate"]


def _long_sql(select_sql, key, cols, label):
    inner = _as_double(select_sql, key, cols)
    return (f"SELECT {label} AS scenario, metric, value FROM "
            f"(UNPIVOT ({inner}) ON {', '.join(cols)} INTO NAME metric VALUE value) u")


L4_SQL = (SPIKE_SQL + ",\nfl1 AS (" + L1_SELECT + ")"
          + DELAY_SQL[DELAY_SQL.index(",\npw AS"):] + ",\nfl2 AS (" + L2_SELECT + ")"
          + FAIL_SQL.replace("WITH ", ",\n", 1)[FAIL_SQL.replace("WITH ", ",\n", 1).index(",\nstops AS"):]
          + ",\nfl3 AS (" + L3_SELECT.replace("FROM fl", "FROM fl_") + ")")
L4_SQL = L4_SQL.replace("\nfl AS (SELECT plan_id, failed_depot,", "\nfl_ AS (SELECT plan_id, failed_depot,")
L4_SQL = L4_SQL.replace("\nper AS (SELECT c.plan_id,", "\nperf AS (SELECT c.plan_id,").replace(
    "FROM per GROUP BY 1, 2)", "FROM perf GROUP BY 1, 2)")
L4_SQL += ("\n" + _long_sql("SELECT * FROM fl1", "factor", L1_COLS,
                            "'Demand Spike ' || CAST(factor AS VARCHAR)")
           + "\nUNION ALL\n" + _long_sql("SELECT * FROM fl2", "delay_days", L2_COLS,
                                         "'Supply Delay ' || CAST(delay_days AS VARCHAR)")
           + "\nUNION ALL\n" + _long_sql(
               "SELECT printf('plan %d depot %d', plan_id, failed_depot) AS case_id, "
               + ", ".join(L3_COLS) + " FROM fl3", "case_id", L3_COLS,
               "'Warehouse Failure ' || case_id"))


@register_plans("L4_scenario_summary", L4_SQL)
def q_scenario_summary(spark, sf_dir, plan):
    """L4: the three scenario families in long form (scenario, metric, value)."""
    from stockroute.operators.scenarios import scenario_summary
    return scenario_summary(q_demand_spike(spark, sf_dir, plan), q_supply_delay(spark, sf_dir, plan),
                            q_depot_failure(spark, sf_dir))


# ---------------------------------------------------------------- reports
@register_plans("F10_store_plan_kpis", PLAN_SQL + "\nSELECT Store, " + ", ".join([
    r("sum(0.05 * lvl + CASE WHEN ord > 0 THEN 5000.0 ELSE 0.0 END)", "total_cost", 4),
    r("sum(0.05 * lvl)", "holding_cost", 4),
    r("sum(CASE WHEN ord > 0 THEN 5000.0 ELSE 0.0 END)", "ordering_cost", 4),
    "count(CASE WHEN ord > 0 THEN 1 END) AS orders_placed",
    r("avg(lvl)", "avg_inventory", 4),
    r("avg(CASE WHEN ord > 0 THEN ord END)", "avg_order_size", 4)]) + " FROM up2 GROUP BY Store")
def q_store_plan_kpis(spark, sf_dir, plan):
    """Per-store plan KPIs."""
    from stockroute.operators.inventory import store_plan_kpis
    return rounded(store_plan_kpis(plan), 4)


@register("M2_cost_comparison", ORACLES["J2_lot_sizing_cost"].replace(
    "SELECT Store, " + r("min(5000.0 * n_orders + 0.05 * (hold_r + hold_c))", "plan_cost", 2)
    + "\nFROM cost WHERE feasible GROUP BY Store",
    ",\npcs AS (SELECT Store, min(5000.0 * n_orders + 0.05 * (hold_r + hold_c)) AS plan_cost\n"
    "        FROM cost WHERE feasible GROUP BY Store),\n"
    "nv AS (SELECT sum(nc) AS naive_cost FROM (SELECT count(*) * 5000.0 + 0.05 * (count(*) * avg(d)"
    " + 0.5 * sum(d)) AS nc FROM ser3 GROUP BY Store) z),\n"
    "op AS (SELECT sum(plan_cost) AS optimised_cost FROM pcs)\n"
    "SELECT " + ", ".join([r("naive_cost", digits=2), r("optimised_cost", digits=2),
                           r("greatest(0.0, naive_cost - optimised_cost)", "savings", 2),
                           r("CASE WHEN naive_cost > 0 THEN (naive_cost - optimised_cost) / naive_cost * 100"
                             " ELSE 0.0 END", "savings_pct", 4)]) + " FROM nv, op"))
def q_cost_comparison(spark, sf_dir):
    """Naive versus optimal (Wagner-Whitin) inventory cost."""
    from stockroute.operators.inventory import naive_cost
    from stockroute.plans.reports import cost_comparison
    naive = naive_cost(demand_series_q(spark, sf_dir), _params().inventory)
    return rounded(cost_comparison(naive, optimal_plan(spark, sf_dir)), 2, savings_pct=4)


@register("M4_history_vs_forecast", V.with_views("lags") + "," + SPLIT_SQL + """
SELECT Store, Dept, Date, """ + r("Weekly_Sales", "value") + """, 'history' AS kind FROM history
UNION ALL
SELECT Store, Dept, Date, """ + r("Sales_RollingMean_4", "value") + """, 'forecast' AS kind
FROM split WHERE split = 'val'""")
def q_history_vs_forecast(spark, sf_dir):
    """M4/H8: every series' history and (moving-average) forecast on one axis."""
    from stockroute.operators.forecast import history_and_forecast
    return rounded(history_and_forecast(history(spark, sf_dir), ma_predictions(spark, sf_dir)))


@register("M3_distance_comparison", TOUR_BASE + """,
nv AS (SELECT plan_id, 2 * sum(km) AS naive_km FROM ranked WHERE rk = 1 GROUP BY plan_id),
fk AS (SELECT plan_id, sum(vkm) AS fleet_km FROM (
         SELECT plan_id, Vehicle, max(Cumulative_Distance_km) AS vkm FROM route_rows GROUP BY 1, 2) z
       GROUP BY plan_id),
ns AS (SELECT k.plan_id, 2 * sum(k.km) AS naive_served_km FROM ranked k
       WHERE k.rk = 1 AND EXISTS (SELECT 1 FROM route_rows r WHERE NOT r.Is_Depot
                                  AND r.plan_id = k.plan_id AND r.stop_id = k.stop_id)
       GROUP BY k.plan_id),
j AS (SELECT nv.plan_id, naive_km, coalesce(fleet_km, 0.0) AS fleet_km,
             coalesce(naive_served_km, 0.0) AS naive_served_km
      FROM nv LEFT JOIN fk ON nv.plan_id = fk.plan_id LEFT JOIN ns ON nv.plan_id = ns.plan_id)
SELECT plan_id, """ + ", ".join([r("naive_km", digits=4), r("fleet_km", digits=4),
                                 r("naive_served_km", digits=4),
                                 r("greatest(0.0, naive_km - fleet_km)", "saved_km", 4),
                                 r("CASE WHEN naive_km > 0 THEN (naive_km - fleet_km) / naive_km * 100 "
                                   "ELSE 0.0 END", "saved_pct", 4)]) + " FROM j")
def q_distance_comparison(spark, sf_dir):
    """Naive round trips versus routed fleet distance per plan."""
    from stockroute.operators.routing import naive_distance, nearest_depot
    from stockroute.plans.reports import distance_comparison
    stops, depots = routing_inputs(spark, sf_dir)
    routes = shared_table(routes_q(spark, sf_dir), "routes")      # read twice below
    out, _ = distance_comparison(nearest_depot(stops, depots), routes)
    return rounded(out, 4)


@register("M6_fleet_summary", TOUR_BASE + """
SELECT plan_id, Vehicle, max(Stop_Order) AS stops, """
          + r("max(Cumulative_Distance_km)", "distance_km", 4) + ", "
          + r("max(Cumulative_Load)", "load", 4)
          + ", count(CASE WHEN NOT Is_Depot THEN 1 END) AS num_stops FROM route_rows GROUP BY 1, 2")
def q_fleet_summary(spark, sf_dir):
    from stockroute.plans.reports import fleet_summary
    return rounded(fleet_summary(routes_q(spark, sf_dir)), 4)


def upload_table(spark, sf_dir):
    """The single-table upload contract filled from the test tables."""
    from stockroute.sources import testdata as TD
    sales = TD.sales_panel(spark, sf_dir)
    feats = TD.features_table(spark, sf_dir)
    stores = TD.stores_dim(spark, sf_dir)
    j = sales.join(stores, "Store", "left").join(feats, ["Store", "Date", "IsHoliday"], "left")
    return j.select("Store", "Dept", "Date", "Weekly_Sales", "IsHoliday", "Temperature",
                    "Fuel_Price", "CPI", "Unemployment", "Type", "Size",
                    *[f"MarkDown{i}" for i in range(1, 6)])


@register("M9_planning_run")
def q_planning_run(spark, sf_dir):
    """M9: the whole run over one uploaded table; returns the scenario summary."""
    from stockroute.plans.runner import run_planning
    res = run_planning(upload_table(spark, sf_dir), _params())
    return res.scenarios


M1_SQL = ("WITH RECURSIVE " + INV_BASE[len("WITH "):] + "," + FALLBACK_CTES + """,
met AS (SELECT avg(abs(Weekly_Sales - Sales_RollingMean_4)) AS val_mae,
               1 - sum((Weekly_Sales - Sales_RollingMean_4) * (Weekly_Sales - Sales_RollingMean_4))
                   / (count(*) * var_pop(Weekly_Sales)) AS val_r2
        FROM split WHERE split = 'val'),
pc AS (SELECT coalesce(sum(0.05 * lvl + CASE WHEN ord > 0 THEN 5000.0 ELSE 0.0 END), 0.0) AS plan_cost
       FROM up2),""" + V.ROUTING + "," + V.TOURS + """,
fk AS (SELECT coalesce(sum(vkm), 0.0) AS fleet_km FROM (
         SELECT plan_id, Vehicle, max(Cumulative_Distance_km) AS vkm FROM route_rows GROUP BY 1, 2) z)
SELECT """ + ", ".join([r("val_mae", digits=4), r("val_r2", digits=4), r("plan_cost", digits=4),
                       r("fleet_km", digits=4)]) + " FROM met, pc, fk")


@register_plans("M1_headline_kpis", M1_SQL)
def q_headline_kpis(spark, sf_dir, plan):
    """M1: forecast MAE and R^2 (validation weeks), plan cost, fleet distance."""
    from stockroute.operators.aggregates import regression_metrics
    from stockroute.plans.reports import headline_kpis
    val = lagged(spark, sf_dir).where(F.col("split") == "val")
    metrics = regression_metrics(val, "Weekly_Sales", "Sales_RollingMean_4") \
        .withColumn("split", F.lit("val"))
    return rounded(headline_kpis(metrics, plan, routes_q(spark, sf_dir)), 4)


# ---------------------------------------------------------------- upload path, audits, labels
UPLOAD_FEATURE_COLS = ["Store", "Dept", "Date", "Weekly_Sales", "IsHoliday", "Temperature",
                       "Fuel_Price", "CPI", "Unemployment", "Type", "Size",
                       "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5",
                       "Year", "Month", "Week", "DayOfYear", "Quarter", "Type_encoded",
                       "Latitude", "Longitude"]
UPLOAD_DOUBLES = {"Weekly_Sales", "Temperature", "Fuel_Price", "CPI", "Unemployment",
                  "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5",
                  "Latitude", "Longitude"}


@register("I3_engineer_features", V.with_views("merged").replace(
    "CAST(CASE m.Type WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS INTEGER)",
    "CAST(coalesce(CASE m.Type WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END, 1) AS INTEGER)")
    + "\nSELECT " + _sel(UPLOAD_FEATURE_COLS, UPLOAD_DOUBLES) + " FROM history")
def q_engineer_features(spark, sf_dir):
    """The single-table upload path (unmapped type -> 1, optional
    markdowns -> 0, medians over the upload)."""
    from stockroute.operators.features import engineer_features
    from stockroute.sources.schemas import store_coordinates
    out = engineer_features(upload_table(spark, sf_dir), store_coordinates(spark))
    return rounded(out.select(*UPLOAD_FEATURE_COLS))


@register("G5_route_running_totals", TOUR_BASE + """
SELECT plan_id, Vehicle, Stop_Order, """ + ", ".join([
    r("coalesce(" + V._hav("lag(Lat) OVER w", "lag(Lon) OVER w", "Lat", "Lon") + ", 0.0)",
      "leg_check", 4),
    r("sum(Demand) OVER (w ROWS UNBOUNDED PRECEDING)", "load_check", 4),
    r("sum(Distance_km) OVER (w ROWS UNBOUNDED PRECEDING)", "distance_check", 4)])
    + " FROM route_rows WINDOW w AS (PARTITION BY plan_id, Vehicle ORDER BY Stop_Order)")
def q_route_running_totals(spark, sf_dir):
    """Legs recomputed from the previous stop and running load and
    distance along every route (audit columns for the tours)."""
    from stockroute.operators.routing import route_legs_audit, running_totals
    audited = running_totals(route_legs_audit(routes_q(spark, sf_dir)))
    return rounded(audited.select("plan_id", "Vehicle", "Stop_Order", "leg_check", "load_check",
                                  "distance_check"), 4)


def _names_values(d: dict) -> str:
    return ", ".join(f"({k}, '{v.replace(chr(39), chr(39) * 2)}')" for k, v in sorted(d.items()))


@register("C16_series_labels", V.with_views("panel") + ",\nsn(Store, Store_Name) AS (VALUES "
          + _names_values(__import__("stockroute.sources.schemas", fromlist=["x"]).STORE_NAMES)
          + "),\ndn(Dept, Dept_Name) AS (VALUES "
          + _names_values(__import__("stockroute.sources.schemas", fromlist=["x"]).DEPT_NAMES)
          + """)
SELECT DISTINCT s.Store, s.Dept,
       CASE WHEN coalesce(length(sn.Store_Name), 0) > 0
            THEN 'Store ' || CAST(s.Store AS VARCHAR) || ' — ' || sn.Store_Name
            ELSE 'Store ' || CAST(s.Store AS VARCHAR) END AS store_label,
       CASE WHEN coalesce(length(dn.Dept_Name), 0) > 0
            THEN 'Dept ' || CAST(s.Dept AS VARCHAR) || ' — ' || dn.Dept_Name
            ELSE 'Dept ' || CAST(s.Dept AS VARCHAR) END AS dept_label
FROM sales s LEFT JOIN sn ON s.Store = sn.Store LEFT JOIN dn ON s.Dept = dn.Dept""")
def q_series_labels(spark, sf_dir):
    """Display labels of every series (store and department names)."""
    from stockroute.plans.reports import with_labels
    from stockroute.sources import testdata as TD
    from stockroute.sources.schemas import dept_names, store_names
    keys = TD.sales_panel(spark, sf_dir).select("Store", "Dept").distinct()
    return with_labels(keys, store_names(spark), dept_names(spark)).select(
        "Store", "Dept", "store_label", "dept_label")


@register("M8_actual_vs_predicted", V.with_views("lags") + "," + SPLIT_SQL + """
SELECT Store, Dept, Date, """ + r("Weekly_Sales") + ", " + r("Sales_RollingMean_4", "Predicted_Sales")
          + " FROM split WHERE split = 'val'")
def q_actual_vs_predicted(spark, sf_dir):
    """Actual versus (moving-average) predicted sales of every series
    over the validation weeks; the dashboard filters one series of it."""
    val = lagged(spark, sf_dir).where(F.col("split") == "val")
    return rounded(val.select("Store", "Dept", "Date", "Weekly_Sales",
                              F.col("Sales_RollingMean_4").alias("Predicted_Sales")))


FUTURE_FEATURE_COLS = ["Store", "Dept", "Date", "Year", "Month", "Week", "DayOfYear", "Quarter",
                       "Sales_Lag_1", "Sales_Lag_2", "Sales_Lag_4", "Sales_Lag_8", "Sales_Lag_12",
                       "Sales_RollingMean_4", "Sales_RollingMean_12", "Sales_RollingStd_4"]


@register("I11_forecast_features", V.with_views("merged") + """,
rk AS (SELECT Store, Dept, Date, Weekly_Sales,
              row_number() OVER (PARTITION BY Store, Dept ORDER BY Date DESC) AS rd,
              count(*) OVER (PARTITION BY Store, Dept) AS n,
              first_value(Weekly_Sales) OVER (PARTITION BY Store, Dept ORDER BY Date) AS first_v
       FROM history),
st AS (SELECT Store, Dept, any_value(n) AS n, any_value(first_v) AS first_v,
              max(CASE WHEN rd = 1 THEN Weekly_Sales END) AS l1,
              max(CASE WHEN rd = 2 THEN Weekly_Sales END) AS l2,
              max(CASE WHEN rd = 4 THEN Weekly_Sales END) AS l4,
              max(CASE WHEN rd = 8 THEN Weekly_Sales END) AS l8,
              max(CASE WHEN rd = 12 THEN Weekly_Sales END) AS l12,
              avg(CASE WHEN rd <= 4 THEN Weekly_Sales END) AS m4,
              avg(CASE WHEN rd <= 12 THEN Weekly_Sales END) AS m12,
              stddev_pop(CASE WHEN rd <= 4 THEN Weekly_Sales END) AS s4
       FROM rk GROUP BY Store, Dept HAVING any_value(n) >= 13),
fut AS (SELECT st.*, CAST((SELECT max(Date) FROM history) + CAST(7 * w.w AS INTEGER) AS DATE) AS Date
        FROM st CROSS JOIN (SELECT unnest(range(1, 14)) AS w) w)
SELECT Store, Dept, Date, CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS Month,
       CAST(weekofyear(Date) AS INTEGER) AS Week, CAST(dayofyear(Date) AS INTEGER) AS DayOfYear,
       CAST(quarter(Date) AS INTEGER) AS Quarter, """ + ", ".join([
    r("CASE WHEN n - 1 >= 0 THEN l1 ELSE first_v END", "Sales_Lag_1"),
    r("CASE WHEN n - 2 >= 0 THEN l2 ELSE first_v END", "Sales_Lag_2"),
    r("CASE WHEN n - 4 >= 0 THEN l4 ELSE first_v END", "Sales_Lag_4"),
    r("CASE WHEN n - 8 >= 0 THEN l8 ELSE first_v END", "Sales_Lag_8"),
    r("CASE WHEN n - 12 >= 0 THEN l12 ELSE first_v END", "Sales_Lag_12"),
    r("m4", "Sales_RollingMean_4"), r("m12", "Sales_RollingMean_12"),
    r("CASE WHEN n >= 4 THEN s4 ELSE 0.0 END", "Sales_RollingStd_4", 4)]) + " FROM fut")
def q_forecast_features(spark, sf_dir):
    """I11 inputs (G7/G8/E6/C4): per eligible series and future week, the
    lags taken from the sales tail (first value when too short), trailing
    means and population std, and the future week's calendar parts."""
    from stockroute.operators.forecast import _future_calendar, _step_features, series_state
    p = _params().forecast
    hist = history(spark, sf_dir)
    last_date = hist.agg(F.max("Date")).scalar()
    st = _step_features(series_state(hist, p), p)
    rows = st.withColumn("w", F.explode(F.sequence(F.lit(1), F.lit(p.horizon)))) \
        .withColumn("_last", last_date)
    rows = _future_calendar(rows, F.col("_last"), F.col("w"))
    return rounded(rows.select(*FUTURE_FEATURE_COLS), Sales_RollingStd_4=4)
