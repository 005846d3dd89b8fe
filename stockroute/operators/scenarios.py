"""What-if scenarios (L1-L4) as aggregate queries.

Each scenario is a closed-form aggregate over predictions, plan and routes.
Parameter lists (several spike factors, delays or failed depots) are
evaluated in the same job by exploding a literal array, not by a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroute.config import InventoryParams, RoutingParams, ScenarioParams
from stockroute.functions.columns import ceil_floor_zero, delay_demand, pct_change, scale_when
from stockroute.operators.routing import depot_distances, fleet_distance


PLAN_BLOCKS = 16


def _lit_array(values, typ="double"):
    return F.array(*[F.lit(v).cast(typ) for v in values])


def scaled_predictions(pred: DataFrame, factor: float, stores=None,
                       value: str = "Predicted_Weekly_Sales") -> DataFrame:
    """Demand scaled for all stores or for the listed stores."""
    cond = None if stores is None else F.col("Store").isin(list(stores))
    return pred.withColumn(value, scale_when(value, factor, cond))


def scaled_routes(routes: DataFrame, factor: float) -> DataFrame:
    """Route loads under a demand spike."""
    return routes.withColumns({"Demand": F.col("Demand") * factor,
                               "Cumulative_Load": F.col("Cumulative_Load") * factor})


def demand_spike(pred: DataFrame, plan: DataFrame, factors=(1.2,), stores=None,
                 s: ScenarioParams = ScenarioParams(), r: RoutingParams = RoutingParams(),
                 value: str = "Predicted_Weekly_Sales") -> DataFrame:
    """L1 for every factor in ``factors`` (one row per factor).

    mean demand = mean of the per-store means (F3/F4); the new cost scales the
    plan cost by the demand ratio and the rush-order penalty; extra vehicles
    = max(0, ceil((f - 1) * vehicles)).
    """
    per_store = pred.groupBy("Store").agg(F.avg(value).alias("m"), F.sum(value).alias("sm"),
                                          F.count(value).alias("cm"))
    hit = F.lit(True) if stores is None else F.col("Store").isin(list(stores))
    rows = per_store.select("Store", "m", "sm", "cm", hit.alias("hit"),
                            F.explode(_lit_array(factors)).alias("factor"))
    scaled = lambda c: F.when(F.col("hit"), F.col(c) * F.col("factor")).otherwise(F.col(c))
    rows = rows.withColumns({"m_new": scaled("m"), "sm_new": scaled("sm")})
    # both means of the application: mean of per-store means (file-based
    # scenarios) and the plain row mean (in-memory runner)
    agg = rows.groupBy("factor").agg(F.avg("m").alias("baseline_avg_demand"),
                                     F.avg("m_new").alias("new_avg_demand"),
                                     (F.sum("sm") / F.sum("cm")).alias("baseline_row_avg_demand"),
                                     (F.sum("sm_new") / F.sum("cm")).alias("new_row_avg_demand"),
                                     F.sum("m").alias("_sb"), F.sum("m_new").alias("_sn"))
    base_cost = F.coalesce(plan.agg(F.sum("Total_Cost")).scalar(), F.lit(0.0))
    ratio = F.col("_sn") / F.greatest(F.col("_sb"), F.lit(1.0))
    new_cost = F.col("baseline_inventory_cost") * ratio * F.lit(s.rush_penalty)
    return (agg.withColumn("baseline_inventory_cost", base_cost)
            .select("factor", "baseline_avg_demand", "new_avg_demand",
                    "baseline_row_avg_demand", "new_row_avg_demand",
                    ((F.col("factor") - 1) * 100).alias("demand_increase_pct"),
                    "baseline_inventory_cost", new_cost.alias("new_inventory_cost"))
            .withColumns({
                "cost_increase": F.col("new_inventory_cost") - F.col("baseline_inventory_cost"),
                "cost_increase_pct": pct_change(F.col("new_inventory_cost"),
                                                F.col("baseline_inventory_cost")),
                "additional_vehicles_needed": ceil_floor_zero(
                    (F.col("factor") - 1) * F.lit(float(r.num_vehicles))),
            }))


def supply_delay(pred: DataFrame, plan: DataFrame, delays=(7,),
                 inv: InventoryParams = InventoryParams(),
                 value: str = "Predicted_Weekly_Sales") -> DataFrame:
    """L2 for every delay in ``delays``: extra safety stock, extra holding
    cost and stores whose lowest planned level is below the extra need.
    Without a planned store there is no row (``scenario_errors`` has one)."""
    avg_week = pred.groupBy("Store").agg(F.avg(value).alias("w"))
    min_level = plan.groupBy("Store").agg(F.min("Inventory_Level").alias("min_level"))
    per = (min_level.join(avg_week, "Store", "full")
           .select("Store", "min_level", "w",
                   F.explode(_lit_array(delays, "int")).alias("delay_days")))
    per = per.withColumn("extra", delay_demand(F.coalesce("w", F.lit(0.0)), F.col("delay_days")))
    agg = per.groupBy("delay_days").agg(
        F.sum(F.when(F.col("w").isNotNull(), F.col("extra"))).alias("extra_safety_stock_total"),
        F.count(F.when(F.col("min_level") < F.col("extra"), 1)).alias("stores_at_stockout_risk"),
        F.count("min_level").alias("_n_plan"))
    base_cost = F.coalesce(plan.agg(F.sum("Total_Cost")).scalar(), F.lit(0.0))
    add = (F.coalesce(F.col("extra_safety_stock_total"), F.lit(0.0)) * F.lit(inv.holding_cost)
           * F.col("delay_days") / F.lit(7.0))
    agg = agg.where(F.col("_n_plan") > 0)      # no planned store: an error record instead
    return (agg.withColumn("baseline_inventory_cost", base_cost)
            .withColumn("additional_holding_cost", add)
            .withColumn("new_inventory_cost", F.col("baseline_inventory_cost")
                        + F.col("additional_holding_cost"))
            .select("delay_days", "extra_safety_stock_total", "additional_holding_cost",
                    "baseline_inventory_cost", "new_inventory_cost",
                    (F.col("new_inventory_cost") - F.col("baseline_inventory_cost"))
                    .alias("cost_increase"),
                    pct_change(F.col("new_inventory_cost"), F.col("baseline_inventory_cost"))
                    .alias("cost_increase_pct"),
                    "stores_at_stockout_risk",
                    (F.col("stores_at_stockout_risk") * 100.0
                     / F.greatest(F.col("_n_plan"), F.lit(1))).alias("stockout_risk_pct")))


def _nearest_two(stops: DataFrame, depots: DataFrame):
    """Per stop: nearest depot distance and runner-up distance; and the places of
    the depots at the minimum distance (ties), as (distances, ties) frames."""
    dd = depot_distances(stops, depots)
    at = F.transform(F.filter("depot_km", lambda x: x["km"] <= F.col("depot_dist")), lambda x: x["place"])
    ties = dd.select("plan_id", "depot_dist", "second_dist", F.explode(F.array_distinct(at)).alias("place"))
    return dd, ties


def depot_failure(stops: DataFrame, depots: DataFrame, routes: DataFrame | None = None,
                  failed=None, s: ScenarioParams = ScenarioParams()) -> DataFrame:
    """L3 per plan and failed depot: stores whose nearest depot fails, new
    round-trip distance over the remaining depots and extra fuel.

    Each stop carries its sorted depot distances; removing depot k changes a
    stop's round trip only when k was its nearest, so one aggregate per
    (plan, nearest depot) gives every failure case.  Baseline = fleet
    distance of ``routes`` or, without routes, the round trips over all depots.
    """
    dd, ties = _nearest_two(stops, depots)
    per_plan = dd.groupBy("plan_id").agg((2 * F.sum("depot_dist")).alias("rt_all"))
    per_place = ties.groupBy("plan_id", "place").agg(
        F.count("*").alias("stores_reassigned"),
        (2 * F.sum(F.coalesce(F.col("second_dist"), F.col("depot_dist"))
                   - F.col("depot_dist"))).alias("extra_km"))
    # depots at one place share its stops
    spots = depots.groupBy("depot_lat", "depot_lon").agg(F.min("depot_idx").alias("place"))
    at = depots.join(spots, ["depot_lat", "depot_lon"]).select("place", F.col("depot_idx").alias("failed_depot"))
    per_k = per_place.join(at, "place").drop("place")
    if failed is not None:                   # explicit failure cases (small literal list)
        ids = F.array(*[F.lit(int(k)) for k in failed])
        cases = per_plan.withColumn("_ids", ids).select(
            "plan_id", "rt_all", F.explode("_ids").alias("failed_depot"))
    else:                                    # every depot of every plan, met in blocks of plans
        spread = per_plan.withColumn("_b", F.pmod(F.hash("plan_id"), F.lit(PLAN_BLOCKS)))
        cases = spread.join(depots.select(
            F.col("depot_idx").alias("failed_depot"),
            F.explode(F.sequence(F.lit(0), F.lit(PLAN_BLOCKS - 1))).alias("_b")), "_b").drop("_b")
    out = cases.join(per_k, ["plan_id", "failed_depot"], "left").select(
        "plan_id", "failed_depot",
        F.coalesce("stores_reassigned", F.lit(0)).alias("stores_reassigned"),
        "rt_all", (F.col("rt_all") + F.coalesce("extra_km", F.lit(0.0))).alias("new_distance_km"))
    if routes is not None:
        base = fleet_distance(routes).select("plan_id", F.col("fleet_km").alias("baseline_km"))
        out = out.join(base, "plan_id", "left").withColumn(
            "baseline_distance_km", F.coalesce("baseline_km", F.col("rt_all"))).drop("baseline_km")
    else:
        out = out.withColumn("baseline_distance_km", F.col("rt_all"))
    inc = F.col("new_distance_km") - F.col("baseline_distance_km")
    return out.drop("rt_all").withColumns({
        "distance_increase_km": inc,
        "distance_increase_pct": pct_change(F.col("new_distance_km"),
                                            F.col("baseline_distance_km")),
        "additional_fuel_cost_estimate": inc * F.lit(s.fuel_cost_per_km),
    })


def scenario_errors(plan: DataFrame, depots: DataFrame, failed=()) -> DataFrame:
    """D9/L3 guards: (scenario, metric, message) for an empty plan and for every
    failed depot that is not among the depots; no rows if all is well."""
    spark = plan.sparkSession
    none = plan.agg(F.count("*").alias("n")).where("n = 0").select(
        F.lit("Supply Delay").alias("scenario"), F.lit("error").alias("metric"),
        F.lit("the inventory plan is empty").alias("message"))
    asked = spark.createDataFrame([(int(k),) for k in failed], "depot_idx int")
    gone = asked.join(depots.select("depot_idx"), "depot_idx", "left_anti").select(
        F.format_string("Warehouse Failure %d", "depot_idx").alias("scenario"), F.lit("error").alias("metric"),
        F.lit("no such depot").alias("message"))
    return none.unionByName(gone)


def to_long(df: DataFrame, scenario: str, key: str | None = None) -> DataFrame:
    """L4 helper: wide metric rows -> (scenario, metric, value) rows."""
    metrics = [c for c in df.columns if c != key]
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"),
                                      F.col(c).cast("double").alias("value")) for c in metrics]))
    name = (F.lit(scenario) if key is None
            else F.concat(F.lit(scenario + " "), F.col(key).cast("string")))
    return df.select(name.alias("scenario"), kv.alias("m")).select(
        "scenario", "m.metric", "m.value")


def scenario_summary(spike: DataFrame, delay: DataFrame, failure: DataFrame) -> DataFrame:
    """L4: all three scenarios in long form."""
    fail = failure.withColumn("case", F.format_string("plan %d depot %d", "plan_id",
                                                      "failed_depot")).drop("plan_id",
                                                                            "failed_depot")
    return (to_long(spike, "Demand Spike", "factor")
            .unionByName(to_long(delay, "Supply Delay", "delay_days"))
            .unionByName(to_long(fail, "Warehouse Failure", "case")))
