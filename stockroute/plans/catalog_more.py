"""Further registered queries: sources and sinks, validation, views, capped
plans, rule forecasts, several vehicles; each with its DuckDB statement."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroute.plans import catalog as C
from stockroute.plans import sqlviews as V
from stockroute.plans.catalog import (
    INV_BASE, SPLIT_SQL, r, register, round_col, rounded)
from stockroute.session import ensure_checkpoint_dir


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _panel(spark, sf_dir) -> DataFrame:
    from stockroute.sources import testdata as TD
    return TD.sales_panel(spark, sf_dir)


# ---------------------------------------------------------------- sources and sinks
PANEL_SQL = V.with_views("panel") + "\nSELECT Store, Dept, Date, " + r("Weekly_Sales") + ", IsHoliday FROM sales"


@register("A1_csv_roundtrip", V.with_views("stores") + "\nSELECT Store, Type, Size FROM stores")
def q_csv(spark, sf_dir):
    """The store dimension exported as CSV and read with its schema."""
    from stockroute.sources import io, schemas, testdata as TD
    path = _folder(spark, "csv")
    io.write_table(TD.stores_dim(spark, sf_dir).select("Store", "Type", "Size"), path, "csv")
    return io.read_csv(spark, path, schemas.STORES_SCHEMA)


@register("A2_csv_dates_roundtrip", PANEL_SQL)
def q_csv_dates(spark, sf_dir):
    from stockroute.sources import io, schemas
    path = _folder(spark, "csv")
    io.write_table(_panel(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales", "IsHoliday"), path, "csv")
    return rounded(io.read_csv(spark, path, schemas.SALES_SCHEMA))


@register("A3_orders_roundtrip", "WITH " + V.RETAIL.strip() + """
SELECT "Order ID" AS order_id, "Order Date" AS order_date, "Ship Date" AS ship_date,
       "Ship Mode" AS ship_mode, "Returned" AS returned, City AS city, State AS state, """
          + r("Sales", "sales") + " FROM retail")
def q_orders_table(spark, sf_dir):
    """A3/A5: the retail order table written as Parquet and read with its schema."""
    from stockroute.sources import io, schemas, testdata as TD
    path = _folder(spark, "orders")
    names = schemas.RETAIL_SCHEMA.fieldNames()
    io.write_table(TD.retail_orders(spark, sf_dir).select(*names), path)
    back = io.read_table(spark, path, schemas.RETAIL_SCHEMA)
    return rounded(back.select(*[F.col(n).alias(n.lower().replace(" ", "_")) for n in names]))


@register("A4_json_roundtrip", PANEL_SQL)
def q_json(spark, sf_dir):
    """Records as JSON lines, many in one file, read again."""
    from stockroute.sources import io, schemas
    path = _folder(spark, "json")
    io.write_json_records(_panel(spark, sf_dir).select(*schemas.SALES_SCHEMA.fieldNames()), path)
    return rounded(io.read_json_records(spark, path, schemas.SALES_SCHEMA))


@register("A11_optional_source", PANEL_SQL)
def q_optional(spark, sf_dir):
    """An absent source is an empty table with the schema."""
    from stockroute.sources import io, schemas
    none = io.read_optional(spark, _folder(spark, "absent"), schemas.SALES_SCHEMA)
    empty = schemas.empty_frame(spark, schemas.SALES_SCHEMA)
    return rounded(_panel(spark, sf_dir).select(*none.columns).unionByName(none).unionByName(empty))


@register("A14_depots_used", "WITH " + V.ROUTING.strip().replace(
    V.ROUTING[V.ROUTING.index("depots AS ("):V.ROUTING.index("sdist AS (")],
    "depots(depot_idx, depot_name, depot_lat, depot_lon) AS (VALUES (0, 'Central Depot', 39.8283::DOUBLE, -98.5795::DOUBLE),"
    " (1, 'East Depot', 35.2271::DOUBLE, -80.8431::DOUBLE), (2, 'West Depot', 34.0522::DOUBLE, -118.2437::DOUBLE)),\n")
          + "\nSELECT plan_id, k AS depot_idx, count(*) AS n, " + r("sum(km)", "km", 4)
          + " FROM ranked WHERE rk = 1 GROUP BY 1, 2")
def q_depots(spark, sf_dir):
    """Stops by nearest of the depots of the parameters."""
    from stockroute.operators.routing import nearest_depot
    from stockroute.sources.schemas import depot_frame
    stops, _ = C.routing_inputs(spark, sf_dir)
    return rounded(nearest_depot(stops, depot_frame(spark)).groupBy("plan_id", "depot_idx").agg(
        F.count("*").alias("n"), F.sum("depot_dist").alias("km")), 4)


# ---------------------------------------------------------------- validation, columns
@register("B2_upload_check", V.with_views("panel") + """
SELECT 'whole' AS upload, count(*) >= 100 AS ok, '' AS message FROM sales
UNION ALL SELECT 'cut', false, 'columns not found: CPI, Size'
UNION ALL SELECT 'empty', false, 'fewer than 100 rows'""")
def q_upload_check(spark, sf_dir):
    """B1/B2/H6: validation of a whole, a cut and an empty upload."""
    from stockroute.operators.validate import validate_upload
    whole = C.upload_table(spark, sf_dir)
    rows = [(n, *validate_upload(df)) for n, df in
            (("whole", whole), ("cut", whole.drop("CPI", "Size")), ("empty", whole.limit(0)))]
    return spark.createDataFrame(rows, "upload string, ok boolean, message string")


@register("C6_date_text", V.with_views("panel")
          + "\nSELECT strftime(Date, '%Y-%m-%d') AS week, count(*) AS n FROM sales GROUP BY 1")
def q_date_text(spark, sf_dir):
    from stockroute.functions.columns import date_text
    return _panel(spark, sf_dir).groupBy(date_text("Date").alias("week")).agg(F.count("*").alias("n"))


@register("C9_absent_markdowns", V.with_views("panel") + """
SELECT Store, CAST(0 AS DOUBLE) AS markdown, count(*) AS n FROM sales GROUP BY Store""")
def q_absent_markdowns(spark, sf_dir):
    """An upload without the optional columns gets them as 0."""
    from stockroute.operators.features import MARKDOWNS, engineer_features
    from stockroute.sources.schemas import store_coordinates
    out = engineer_features(C.upload_table(spark, sf_dir).drop(*MARKDOWNS), store_coordinates(spark))
    total = sum((F.col(m) for m in MARKDOWNS[1:]), F.col(MARKDOWNS[0]))
    return out.groupBy("Store").agg(F.sum(total).alias("markdown"), F.count("*").alias("n"))


@register("C21_half_even", "SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 8.0, 2) AS DOUBLE) AS eighth"
          " FROM lineitem")
def q_half_even(spark, sf_dir):
    """Ties (eighths) go to the even digit."""
    from stockroute.functions.columns import round2
    from stockroute.sources.testdata import table
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    return li.select("l_orderkey", "l_linenumber", round2(F.col("l_quantity") / 8, half_even=True).alias("eighth"))


@register("C30_default_demand", "WITH " + V.ROUTING.strip()
          + "\nSELECT plan_id, stop_id, demand IS NOT NULL AND stop_id % 3 <> 0 AS known, "
          + r("CASE WHEN stop_id % 3 <> 0 THEN demand END", "demand") + ", true AS in_range FROM stops")
def q_default_demand(spark, sf_dir):
    """A third of the demands blanked; the filled ones lie in their range."""
    from stockroute.functions.columns import default_demand
    stops, _ = C.routing_inputs(spark, sf_dir)
    blank = F.when(F.col("stop_id") % 3 != 0, F.col("demand"))
    s = stops.withColumn("b", blank).withColumn("f", default_demand(F.col("b"), F.col("stop_id")))
    return rounded(s.select("plan_id", "stop_id", F.col("b").isNotNull().alias("known"), F.col("b").alias("demand"),
                            (F.col("b").isNotNull() | F.col("f").between(1000, 9999)).alias("in_range")))


# ---------------------------------------------------------------- views, order
VIEW_STORE, VIEW_DEPT = 3, 1


@register("M4_one_series", V.with_views("lags") + "," + SPLIT_SQL + f"""
SELECT Store, Dept, Date, {r("Weekly_Sales", "value")}, 'history' AS kind FROM history
WHERE Store = {VIEW_STORE} AND Dept = {VIEW_DEPT}
UNION ALL
SELECT Store, Dept, Date, {r("Sales_RollingMean_4", "value")}, 'forecast' AS kind
FROM split WHERE split = 'val' AND Store = {VIEW_STORE} AND Dept = {VIEW_DEPT}""")
def q_one_series(spark, sf_dir):
    """One series on one axis, by date."""
    from stockroute.plans.reports import series_view
    return rounded(series_view(C.history(spark, sf_dir), C.ma_predictions(spark, sf_dir), VIEW_STORE, VIEW_DEPT))


@register("M5_store_schedule", C.J5_SQL.replace(" FROM pl2", f" FROM pl2 WHERE Store = {VIEW_STORE}"))
def q_store_schedule(spark, sf_dir):
    """M5/H2: the schedule of one store, by week."""
    from stockroute.plans.reports import store_plan_view
    rows, _ = store_plan_view(C.optimal_plan(spark, sf_dir), VIEW_STORE)
    return rounded(rows, 2)


@register("M7_scenario_cards", "SELECT * FROM (" + C.ORACLES["L4_scenario_summary"]
          + ") s WHERE starts_with(scenario, 'Supply Delay')")
def q_cards(spark, sf_dir):
    from stockroute.plans.reports import scenario_cards
    return scenario_cards(C.q_scenario_summary(spark, sf_dir, C.optimal_plan(spark, sf_dir)), "Supply Delay")


@register("M8_one_series", V.with_views("lags") + "," + SPLIT_SQL + "\nSELECT Store, Dept, Date, "
          + r("Weekly_Sales") + ", " + r("Sales_RollingMean_4", "Predicted_Sales")
          + f" FROM split WHERE split = 'val' AND Store = {VIEW_STORE} AND Dept = {VIEW_DEPT}")
def q_one_validation(spark, sf_dir):
    from stockroute.plans.reports import actual_vs_predicted
    val = C.lagged(spark, sf_dir).where(F.col("split") == "val").select(
        "Store", "Dept", "Date", "Weekly_Sales", F.col("Sales_RollingMean_4").alias("Predicted_Sales"))
    return rounded(actual_vs_predicted(val, VIEW_STORE, VIEW_DEPT))


@register("H3_top_weeks", V.with_views("panel") + """
SELECT Date, """ + r("sum(Weekly_Sales)", "sales", 4) + """ FROM sales GROUP BY Date
ORDER BY sum(Weekly_Sales) DESC LIMIT 12""")
def q_top_weeks(spark, sf_dir):
    """H1/H3: the weeks of the highest sales (the limit is the feature)."""
    from stockroute.plans.reports import top_k
    weeks = _panel(spark, sf_dir).groupBy("Date").agg(F.sum("Weekly_Sales").alias("sales"))
    return rounded(top_k(weeks, "sales", 12), 4)


@register("H4_preview", V.with_views("panel") + "\nSELECT least(count(*), 5) AS n FROM sales")
def q_preview(spark, sf_dir):
    """H4: a head of five rows; which ones is free."""
    from stockroute.plans.reports import preview
    return preview(_panel(spark, sf_dir)).agg(F.count("*").alias("n"))


@register("D2_spike_some_stores", V.with_views("lags") + "," + SPLIT_SQL + """
SELECT Store, """ + r("sum(CASE WHEN Store IN (1, 4) THEN Sales_RollingMean_4 * 1.2 ELSE Sales_RollingMean_4 END)",
                      "demand", 4) + " FROM split WHERE split = 'val' GROUP BY Store")
def q_some_stores(spark, sf_dir):
    """Demand scaled for listed stores only."""
    from stockroute.operators.scenarios import scaled_predictions
    out = scaled_predictions(C.ma_predictions(spark, sf_dir), 1.2, [1, 4])
    return rounded(out.groupBy("Store").agg(F.sum("Predicted_Weekly_Sales").alias("demand")), 4)


@register("C25_spike_loads", C.TOUR_BASE + "\nSELECT plan_id, Vehicle, Stop_Order, " + r("Demand * 1.2", "Demand", 4)
          + ", " + r("Cumulative_Load * 1.2", "Cumulative_Load", 4) + " FROM route_rows")
def q_spike_loads(spark, sf_dir):
    """Route loads under a demand spike."""
    from stockroute.operators.scenarios import scaled_routes
    return rounded(scaled_routes(C.routes_q(spark, sf_dir), 1.2).select(
        "plan_id", "Vehicle", "Stop_Order", "Demand", "Cumulative_Load"), 4)


@register("D9_error_records", """
SELECT 'Supply Delay' AS scenario, 'error' AS metric, 'the inventory plan is empty' AS message
UNION ALL SELECT 'Warehouse Failure ' || CAST(max(r_regionkey) + 1 AS VARCHAR), 'error', 'no such depot' FROM region""")
def q_errors(spark, sf_dir):
    """D9 and the guard of L3: an empty plan, and a depot beyond the table."""
    from stockroute.operators.scenarios import scenario_errors
    _, depots = C.routing_inputs(spark, sf_dir)
    beyond = depots.agg(F.max("depot_idx")).first()[0] + 1
    return scenario_errors(C.fallback_plan(spark, sf_dir).limit(0), depots, (0, beyond))


@register("F17_sales_histogram_in_view", V.with_views("panel") + """,
b AS (SELECT CAST(least(floor((Weekly_Sales + 5000) / 1050.0), 99) AS INTEGER) AS bin FROM sales
      WHERE Weekly_Sales BETWEEN -5000 AND 100000)
SELECT bin, """ + r("-5000 + bin * 1050.0", "bin_lo", 4) + ", " + r("-5000 + (bin + 1) * 1050.0", "bin_hi", 4)
          + ", count(*) AS n FROM b GROUP BY bin")
def q_histogram_view(spark, sf_dir):
    """F17 with the limits of the view: -5000 to 100000."""
    from stockroute.operators.aggregates import histogram
    return rounded(histogram(_panel(spark, sf_dir), "Weekly_Sales", 100, -5000, 100000), 4)


@register("K11_route_geojson", C.TOUR_BASE + """
SELECT plan_id, Vehicle, count(*) AS points, """ + r("sum(Lon)", "lon", 4) + ", " + r("sum(Lat)", "lat", 4)
          + " FROM route_rows GROUP BY 1, 2")
def q_geojson(spark, sf_dir):
    """The GeoJSON text parsed again."""
    from stockroute.operators.routing import route_paths
    shape = "struct<geometry:struct<type:string,coordinates:array<array<double>>>,properties:struct<vehicle:string>>"
    g = route_paths(C.routes_q(spark, sf_dir)).select("plan_id", F.from_json("geojson", shape).alias("g"))
    p = g.select("plan_id", F.col("g.properties.vehicle").alias("Vehicle"), F.explode("g.geometry.coordinates").alias("c"))
    return rounded(p.groupBy("plan_id", "Vehicle").agg(
        F.count("*").alias("points"), F.sum(F.col("c")[0]).alias("lon"), F.sum(F.col("c")[1]).alias("lat")), 4)


# ---------------------------------------------------------------- capped plans
CAP_SQL = INV_BASE + """,
need AS (SELECT *, greatest(cmax - 0.5 * ss, 0.0) AS req, {cap} * ss AS cap FROM ser3),
masks AS (SELECT Store, unnest(range(0, CAST(1 AS BIGINT) << CAST(nT AS BIGINT))) AS m
          FROM (SELECT DISTINCT Store, nT FROM need) x),
walk(Store, m, t, lvl, cost) AS (
  SELECT k.Store, k.m, n.t, n.req, CAST(0 AS DOUBLE) FROM masks k JOIN need n ON k.Store = n.Store AND n.t = n.nT
  UNION ALL
  SELECT w.Store, w.m, w.t - 1,
    CASE WHEN (w.m >> (w.t - 1)) & 1 = 1 THEN greatest(coalesce(b.req, 0.0), w.lvl - n.cap) ELSE w.lvl END,
    w.cost + 0.05 * (1.5 * n.ss + w.lvl - n.cum) + CASE WHEN (w.m >> (w.t - 1)) & 1 = 1 THEN 5000.0 ELSE 0.0 END
  FROM walk w JOIN need n ON n.Store = w.Store AND n.t = w.t
       LEFT JOIN need b ON b.Store = w.Store AND b.t = w.t - 1
  WHERE w.t > 0),
best AS (SELECT Store, min(cost) AS cost FROM walk WHERE t = 0 AND lvl <= 0 GROUP BY Store),
up AS (SELECT Store, t AS Week, d, greatest(1.5 * ss, ss + cmax) - cum AS lvl, ss FROM ser3),
up2 AS (SELECT *, CASE WHEN d + ss - coalesce(lag(lvl) OVER (PARTITION BY Store ORDER BY Week), 1.5 * ss)
          > 1e-9 * greatest(1.0, abs(ss)) THEN 1 ELSE 0 END AS placed FROM up),
fb AS (SELECT Store, sum(0.05 * lvl + 5000.0 * placed) AS cost FROM up2 GROUP BY Store)
SELECT Store, """ + r("coalesce(best.cost, fb.cost)", "cost", 2) + """, best.cost IS NOT NULL AS feasible
FROM fb LEFT JOIN best USING (Store)"""


def _capped(spark, sf_dir, cap: float) -> DataFrame:
    from stockroute.operators.inventory import plan_rows, plan_with_cap
    p = C._params().inventory
    plan = plan_rows(plan_with_cap(C.demand_series_q(spark, sf_dir), p, F.col("safety") * cap), p, order_threshold=0.0)
    return plan.groupBy("Store").agg(round_col(F.sum("Total_Cost"), 2).alias("cost"), F.max("feasible").alias("feasible"))


def _cap_query(name: str, cap: float):
    @register(name, "WITH RECURSIVE " + CAP_SQL.replace("{cap}", repr(cap))[len("WITH "):])
    def q(spark, sf_dir):
        """J2/J5 with a binding cap, against every set of order weeks."""
        return _capped(spark, sf_dir, cap)
    return q


_cap_query("J2_capped_plan", 1.6)
_cap_query("J2_cap_out_of_reach", 0.7)


# ---------------------------------------------------------------- forecasts by a rule
def _rule():
    """A forecast rule over the features: a blend of the two moving averages."""
    return F.col("Sales_RollingMean_4") * 0.37 + F.col("Sales_RollingMean_12") * 0.63


RULE = "greatest(0.0, 0.37 * m4 + 0.63 * m12)"
TAIL_SQL = V.with_views("merged") + """,
rk AS (SELECT Store, Dept, Weekly_Sales, Date, row_number() OVER (PARTITION BY Store, Dept ORDER BY Date DESC) AS rd,
              count(*) OVER (PARTITION BY Store, Dept) AS n FROM history),
tail AS (SELECT Store, Dept, list(Weekly_Sales ORDER BY Date) AS v FROM rk WHERE rd <= 12 AND n >= 13 GROUP BY 1, 2),
lastd AS (SELECT max(Date) AS d FROM history)"""
DIRECT_SQL = TAIL_SQL + """,
pr AS (SELECT Store, Dept, list_avg(v[-4:]) AS m4, list_avg(v) AS m12 FROM tail)
SELECT CAST(Store AS INTEGER) AS Store, CAST(Dept AS INTEGER) AS Dept, CAST(d + CAST(7 * w AS INTEGER) AS DATE) AS Date, """ \
    + "CAST(round_even(" + RULE + ", 2) AS DOUBLE) AS Predicted_Weekly_Sales FROM pr, lastd, (SELECT unnest(range(1, 14)) AS w) x"
RECURSIVE_SQL = "WITH RECURSIVE " + TAIL_SQL[len("WITH "):] + """,
step(Store, Dept, w, v) AS (
  SELECT Store, Dept, 0, v FROM tail
  UNION ALL
  SELECT Store, Dept, w + 1, list_append(v[2:], greatest(0.0, 0.37 * list_avg(v[-4:]) + 0.63 * list_avg(v)))
  FROM step WHERE w < 13)
SELECT CAST(Store AS INTEGER) AS Store, CAST(Dept AS INTEGER) AS Dept, CAST(d + CAST(7 * w AS INTEGER) AS DATE) AS Date, """ \
    + "CAST(round_even(v[-1], 2) AS DOUBLE) AS Predicted_Weekly_Sales FROM step, lastd WHERE w > 0"


@register("I11_direct_rule", DIRECT_SQL)
def q_direct_rule(spark, sf_dir):
    from stockroute.operators.forecast import forecast_direct
    return forecast_direct(_rule(), C.ml_history(spark, sf_dir), C._params().forecast)


@register("I12_recursive_rule", RECURSIVE_SQL)
def q_recursive_rule(spark, sf_dir):
    """Thirteen weeks, each fed back, against a recursive statement."""
    from stockroute.operators.forecast import forecast_recursive
    return forecast_recursive(_rule(), C.ml_history(spark, sf_dir), C._params().forecast)


@register("I13_stage_rule", V.with_views("lags") + "," + SPLIT_SQL + """,
e AS (SELECT split, Weekly_Sales AS y, Weekly_Sales - (0.37 * Sales_RollingMean_4 + 0.63 * Sales_RollingMean_12) AS e
      FROM split)
SELECT split, count(*) AS n, """ + r("avg(abs(e))", "mae", 4) + ", " + r("sqrt(avg(e * e))", "rmse", 4) + ", "
          + r("1 - sum(e * e) / (count(*) * var_pop(y))", "r2", 4) + " FROM e GROUP BY split")
def q_stage_rule(spark, sf_dir):
    """The forecast stage with a rule; its metrics per split."""
    from stockroute.operators.forecast import forecast_stage
    _, metrics, _, _, _ = forecast_stage(C.history(spark, sf_dir), C._params().forecast, predictor=_rule())
    return rounded(metrics, 4)


@register("F2_run_stops", V.with_views("merged") + """,
names(Store, nm) AS (VALUES """ + ", ".join(
    f"({k}, '{v.replace(chr(39), chr(39) * 2)}')" for k, v in sorted(
        __import__("stockroute.sources.schemas", fromlist=["x"]).STORE_NAMES.items())) + """)
SELECT CAST(h.Store AS BIGINT) AS stop_id, coalesce(any_value(n.nm), 'Store ' || CAST(h.Store AS VARCHAR)) AS stop_name,
       """ + r("any_value(h.Latitude)", "lat") + ", " + r("any_value(h.Longitude)", "lon") + ", "
          + r("sum(h.Weekly_Sales)", "demand", 2) + """
FROM history h LEFT JOIN names n ON h.Store = n.Store GROUP BY h.Store""")
def q_run_stops(spark, sf_dir):
    """The run's stops: every store of the panel, defaults where the sample has none."""
    from stockroute.plans.runner import stops_from_predictions
    pred = C.history(spark, sf_dir).select("Store", F.col("Weekly_Sales").alias("Predicted_Weekly_Sales"))
    return rounded(stops_from_predictions(spark, pred, 5000.0).drop("plan_id"), demand=2)


@register("A12_results_roundtrip", V.with_views("lags") + "," + SPLIT_SQL + """,
s AS (SELECT Store, Dept, count(*) AS n FROM history GROUP BY 1, 2 HAVING count(*) >= 13)
SELECT 'predictions' AS name, 13 * count(*) AS n FROM s
UNION ALL SELECT 'inventory_plan', 13 * count(DISTINCT Store) FROM s
UNION ALL SELECT 'naive_cost', count(DISTINCT Store) FROM s
UNION ALL SELECT 'validation', count(*) FROM split WHERE split = 'val'
UNION ALL SELECT 'metrics', count(DISTINCT split) FROM split
UNION ALL SELECT 'feature_importance', 0
UNION ALL SELECT 'naive_distance', 1
UNION ALL SELECT 'scenarios', 24
UNION ALL SELECT 'history', count(*) FROM history""")
def q_results(spark, sf_dir):
    """A whole run by the rule, saved and read again: rows per table."""
    from stockroute.plans.runner import run_planning
    from stockroute.sources import io
    res = run_planning(C.upload_table(spark, sf_dir), C._params(), predictor=_rule())
    res.model = None
    path = _folder(spark, "results")
    io.save_results(res, path)
    back = io.load_results(spark, path)
    out = None
    for name in ("predictions", "inventory_plan", "naive_cost", "validation", "metrics", "feature_importance",
                 "naive_distance", "scenarios", "history"):
        one = getattr(back, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- fitted model, what SQL can state
@register("I9_model_metric_bounds", V.with_views("lags") + "," + SPLIT_SQL
          + "\nSELECT split, count(*) AS n, true AS rmse_from_mae, true AS r2_to_one FROM split GROUP BY split")
def q_metric_bounds(spark, sf_dir):
    m = C.q_model_metrics(spark, sf_dir)
    return m.select("split", "n", (F.col("rmse") >= F.col("mae")).alias("rmse_from_mae"), (F.col("r2") <= 1).alias("r2_to_one"))


@register("I10_importance_sum", "SELECT 27 AS features, CAST(1 AS DOUBLE) AS total, count(*) >= 0 AS none_negative FROM region")
def q_importance_sum(spark, sf_dir):
    i = C.q_importance(spark, sf_dir)
    return i.agg(F.count_distinct("feature").cast("int").alias("features"), F.round(F.sum("importance"), 4).alias("total"),
                 (F.min("importance") >= 0).alias("none_negative"))


KEYS_SQL = TAIL_SQL + """
SELECT CAST(Store AS INTEGER) AS Store, CAST(Dept AS INTEGER) AS Dept, CAST(d + CAST(7 * w AS INTEGER) AS DATE) AS Date,
       true AS non_negative FROM tail, lastd, (SELECT unnest(range(1, 14)) AS w) x"""


@register("I11_direct_keys", KEYS_SQL)
def q_direct_keys(spark, sf_dir):
    return C.q_forecast_direct(spark, sf_dir).select(
        "Store", "Dept", "Date", (F.col("Predicted_Weekly_Sales") >= 0).alias("non_negative"))


@register("I12_recursive_keys", KEYS_SQL)
def q_recursive_keys(spark, sf_dir):
    return C.q_forecast_recursive(spark, sf_dir).select(
        "Store", "Dept", "Date", (F.col("Predicted_Weekly_Sales") >= 0).alias("non_negative"))


# ---------------------------------------------------------------- several vehicles
VEHICLES, LOAD_SHARE = 15, 0.3      # three per depot; a vehicle holds 0.3 of a mean group


def _multi_vehicle_sql() -> str:
    hav = V._hav("t.lat", "t.lon", "a.lat", "a.lon")
    return "WITH RECURSIVE " + V.ROUTING.strip() + "," + V.TOURS[:V.TOURS.index("tour(plan_id")] + f"""
cap AS (SELECT {LOAD_SHARE} * sum(demand) / count(DISTINCT (plan_id, depot_idx)) AS c FROM assigned),
tour(plan_id, depot_idx, v, ord, lat, lon, load, visited, stop_id, cum, km) AS (
  SELECT plan_id, depot_idx, 0, 0, depot_lat, depot_lon, CAST(0 AS DOUBLE), CAST([] AS BIGINT[]),
         CAST(NULL AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM grp
  UNION ALL
  SELECT plan_id, depot_idx, v, ord, lat, lon, load, visited, stop_id, cum, km FROM (
    SELECT t.plan_id, t.depot_idx, CASE WHEN a.stop_id IS NULL THEN t.v + 1 ELSE t.v END AS v,
           CASE WHEN a.stop_id IS NULL THEN 0 ELSE t.ord + 1 END AS ord,
           coalesce(a.lat, g.depot_lat) AS lat, coalesce(a.lon, g.depot_lon) AS lon,
           CASE WHEN a.stop_id IS NULL THEN 0.0 ELSE t.load + a.demand END AS load,
           CASE WHEN a.stop_id IS NULL THEN t.visited ELSE list_append(t.visited, a.stop_id) END AS visited,
           a.stop_id, CASE WHEN a.stop_id IS NULL THEN 0.0 ELSE t.cum + {hav} END AS cum,
           CASE WHEN a.stop_id IS NULL THEN 0.0 ELSE {hav} END AS km,
           row_number() OVER (PARTITION BY t.plan_id, t.depot_idx ORDER BY {hav} NULLS LAST, a.stop_id) AS rn
    FROM tour t JOIN grp g ON g.plan_id = t.plan_id AND g.depot_idx = t.depot_idx
         LEFT JOIN assigned a ON a.plan_id = t.plan_id AND a.depot_idx = t.depot_idx
              AND NOT list_contains(t.visited, a.stop_id) AND t.load + a.demand <= (SELECT c FROM cap)
    WHERE a.stop_id IS NOT NULL OR (t.ord > 0 AND t.v + 1 < 3)) x WHERE rn = 1)
SELECT plan_id, depot_idx, printf('V%d_%d', depot_idx + 1, v + 1) AS Vehicle, ord AS Stop_Order, stop_id, """ + ", ".join(
        [r("load", "Cumulative_Load", 4), r("km", "Distance_km", 4), r("cum", "Cumulative_Distance_km", 4)]) \
        + " FROM tour WHERE stop_id IS NOT NULL"


def _multi_vehicle(spark, sf_dir, limit: int, lease: int = 20_000) -> DataFrame:
    from stockroute.operators.routing import nearest_depot, solve_routes
    stops, depots = C.routing_inputs(spark, sf_dir)
    groups = nearest_depot(stops, depots).groupBy("plan_id", "depot_idx").agg(F.sum("demand").alias("d"))
    cap = groups.agg(F.sum("d") / F.count("*")).first()[0] * LOAD_SHARE
    p = replace(C._params().routing, num_vehicles=VEHICLES, capacity=cap, local_group_limit=limit, lease=lease)
    routes = solve_routes(stops, depots, p)
    return rounded(routes.where(~F.col("Is_Depot")).select(
        "plan_id", "depot_idx", "Vehicle", "Stop_Order", "stop_id", "Cumulative_Load", "Distance_km",
        "Cumulative_Distance_km"), 4)


@register("K4_multi_vehicle", _multi_vehicle_sql())
def q_multi_vehicle(spark, sf_dir):
    """K3/K4: three vehicles a depot, each opened when the last one is full."""
    return _multi_vehicle(spark, sf_dir, C._params().routing.local_group_limit)


@register("K4_hot_groups", _multi_vehicle_sql())
def q_hot_groups(spark, sf_dir):
    """K4: the same tours with every group walked by leases of 16 stops."""
    return _multi_vehicle(spark, sf_dir, 0, lease=16)


# ---------------------------------------------------------------- nearest stops and depots
@register("K1_nearest_stops", "WITH " + V.ROUTING.strip() + """,
pairs AS (SELECT a.plan_id, a.stop_id, b.stop_id AS neighbour_id, """ + V._hav("a.lat", "a.lon", "b.lat", "b.lon") + """ AS km
          FROM stops a JOIN stops b ON a.plan_id = b.plan_id AND a.stop_id <> b.stop_id),
nearest AS (SELECT *, row_number() OVER (PARTITION BY plan_id, stop_id ORDER BY km, neighbour_id) AS rk FROM pairs)
SELECT plan_id, stop_id, CAST(rk AS INTEGER) AS rank, neighbour_id, """ + r("km", digits=4) + " FROM nearest WHERE rk <= 5")
def q_nearest_stops(spark, sf_dir):
    """The five nearest other stops of every stop in its plan."""
    from stockroute.operators.routing import stop_neighbours
    stops, _ = C.routing_inputs(spark, sf_dir)
    return rounded(stop_neighbours(stops, 5), 4)


@register("K2_many_depots", "WITH " + V.ROUTING.strip() + """,
sites AS (SELECT c_custkey AS site_id, """ + V.hash_lat("c_name || '_' || CAST(c_nationkey AS VARCHAR)") + " AS s_lat, "
          + V.hash_lon("c_name || '_' || CAST(c_nationkey AS VARCHAR)") + """ AS s_lon FROM customer),
far AS (SELECT s.plan_id, s.stop_id, site_id, """ + V._hav("s.lat", "s.lon", "s_lat", "s_lon") + """ AS km FROM stops s CROSS JOIN sites),
two AS (SELECT *, row_number() OVER (PARTITION BY plan_id, stop_id ORDER BY km, site_id) AS rk FROM far)
SELECT plan_id, stop_id, min(CASE WHEN rk = 1 THEN site_id END) AS depot_idx, """
          + r("min(CASE WHEN rk = 1 THEN km END)", "depot_km", 4) + ", " + r("min(CASE WHEN rk = 2 THEN km END)", "second_km", 4)
          + " FROM two WHERE rk <= 2 GROUP BY 1, 2")
def q_many_depots(spark, sf_dir):
    """E5/K2: every customer a depot - more depots than stops, searched by cells."""
    from stockroute.functions.columns import hash_coordinates
    from stockroute.operators.routing import depot_distances
    from stockroute.sources import testdata as TD
    stops, _ = C.routing_inputs(spark, sf_dir)
    lat, lon = hash_coordinates(F.col("c_name"), F.col("c_nationkey"))
    sites = TD.table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey").select(
        F.col("c_custkey").alias("depot_idx"), lat.alias("depot_lat"), lon.alias("depot_lon"))
    return depot_distances(stops, sites).select(
        "plan_id", "stop_id", "depot_idx", round_col("depot_dist", 4).alias("depot_km"),
        round_col("second_dist", 4).alias("second_km"))


# ---------------------------------------------------------------- contents of a saved run
RUN_SQL = "WITH RECURSIVE " + V.with_views("lags")[len("WITH "):] + "," + SPLIT_SQL + TAIL_SQL[len(V.with_views("merged")):] + """,
step(Store, Dept, w, v) AS (
  SELECT Store, Dept, 0, v FROM tail
  UNION ALL
  SELECT Store, Dept, w + 1, list_append(v[2:], greatest(0.0, 0.37 * list_avg(v[-4:]) + 0.63 * list_avg(v)))
  FROM step WHERE w < 13),
pred AS (SELECT Store, w, CAST(round_even(v[-1], 2) AS DOUBLE) AS p FROM step WHERE w > 0),
weekly AS (SELECT Store, w, sum(p) AS d FROM pred GROUP BY 1, 2),
err AS (SELECT split, Store, Weekly_Sales AS y, 0.37 * Sales_RollingMean_4 + 0.63 * Sales_RollingMean_12 AS p FROM split),
found AS (
  SELECT 'predictions' AS name, CAST(Store AS VARCHAR) AS part, sum(p) AS total FROM pred GROUP BY Store
  UNION ALL SELECT 'inventory_plan', CAST(Store AS VARCHAR), sum(d) FROM weekly GROUP BY Store
  UNION ALL SELECT 'naive_cost', CAST(Store AS VARCHAR), count(*) * 5000.0 + 0.05 * (sum(d) + 0.5 * sum(d)) FROM weekly GROUP BY Store
  UNION ALL SELECT 'validation', CAST(Store AS VARCHAR), sum(p) FROM err WHERE split = 'val' GROUP BY Store
  UNION ALL SELECT 'metrics', split, avg(abs(y - p)) FROM err GROUP BY split
  UNION ALL SELECT 'history', CAST(Store AS VARCHAR), sum(Weekly_Sales) FROM history GROUP BY Store)
SELECT name, part, """ + r("total", "total", 2) + " FROM found"


@register("M9_run_contents", RUN_SQL)
def q_run_contents(spark, sf_dir):
    """A whole run by the rule, saved over an earlier one and read again: what
    its tables hold, by store or split."""
    from stockroute.plans.runner import run_planning
    from stockroute.sources import io
    res = run_planning(C.upload_table(spark, sf_dir), C._params(), predictor=_rule())
    res.model = None
    path = _folder(spark, "results")
    earlier = replace(res, predictions=res.predictions.limit(0), history=None)
    io.save_results(earlier, path)
    io.save_results(res, path, keep=1)
    back = io.load_results(spark, path)
    whole = {"predictions": ("Store", "Predicted_Weekly_Sales"), "inventory_plan": ("Store", "Demand"),
             "naive_cost": ("Store", "naive_cost"), "validation": ("Store", "Predicted_Sales"),
             "metrics": ("split", "mae"), "history": ("Store", "Weekly_Sales")}
    out = None
    for name, (part, value) in whole.items():
        one = getattr(back, name).groupBy(F.col(part).cast("string").alias("part")).agg(F.sum(value).alias("total"))
        one = one.select(F.lit(name).alias("name"), "part", "total")
        out = one if out is None else out.unionByName(one)
    return rounded(out, 2)
