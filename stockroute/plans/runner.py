"""M9: the whole planning run over one uploaded table.

upload -> validation (B1/B2) -> features (I3) -> lags, split, GBT fit (I5-I7)
-> metrics (I9) -> recursive forecast (I12) -> inventory plan (J5) and naive
cost (J6) -> routes (K6) and naive distance (K9) -> scenarios (L1-L4).
Everything stays a lazy DataFrame except the model fit and the size checks;
progress is reported through Spark job descriptions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroute.config import PlanningParams
from stockroute.operators import forecast as FC
from stockroute.operators import inventory as INV
from stockroute.operators import routing as RT
from stockroute.operators import scenarios as SC
from stockroute.operators.features import add_coordinates, engineer_features
from stockroute.operators.joins import lookup_with_default
from stockroute.operators.validate import validate_upload
from stockroute.session import counted_table, shared_table
from stockroute.sources.schemas import depot_frame, store_coordinates, store_names


@dataclass
class Results:
    """Bundle of one run (all lazy DataFrames except ``model``)."""
    model: object
    metrics: DataFrame
    feature_importance: DataFrame
    validation: DataFrame
    predictions: DataFrame
    inventory_plan: DataFrame
    naive_cost: DataFrame
    routes: DataFrame
    naive_distance: DataFrame
    scenarios: DataFrame
    history: DataFrame
    scenario_errors: DataFrame
    spike_routes: DataFrame


def _describe(spark, text: str, progress=None) -> None:
    spark.sparkContext.setJobDescription(text)
    if progress is not None:
        progress(text)


def stops_from_predictions(spark, predictions: DataFrame, default_demand: float) -> DataFrame:
    """Stops of the run: every store of the predictions with its 13-week demand
    (missing -> ``default_demand``), named by city (else ``Store N``), at its
    coordinates (else the default ones)."""
    demand = predictions.groupBy("Store").agg(F.sum("Predicted_Weekly_Sales").alias("demand"))
    named = lookup_with_default(add_coordinates(demand, store_coordinates(spark)), store_names(spark), "Store", {})
    return named.select(
        F.lit(0).cast("long").alias("plan_id"), F.col("Store").cast("long").alias("stop_id"),
        F.coalesce("Store_Name", F.concat(F.lit("Store "), F.col("Store").cast("string"))).alias("stop_name"),
        F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"),
        F.coalesce("demand", F.lit(float(default_demand))).alias("demand"))


def run_planning(upload: DataFrame, params: PlanningParams = PlanningParams(),
                 progress=None, recursive: bool = True, predictor: Column | None = None) -> Results:
    """The whole run; with ``predictor`` (a Column over the features) that rule
    stands in for the fitted trees."""
    spark = upload.sparkSession
    ok, msg = validate_upload(upload)
    if not ok:
        raise ValueError(msg)
    fp = params.forecast
    _describe(spark, "features", progress)
    hist, seen = counted_table(engineer_features(upload, store_coordinates(spark)), "history", last=F.max("Date"))
    _describe(spark, "forecast model", progress)
    model, metrics, validation, preds, importance = FC.forecast_stage(hist, fp, recursive, predictor, seen)
    _describe(spark, "forecast", progress)
    preds = shared_table(preds, "predictions")
    _describe(spark, "inventory", progress)
    series = INV.demand_series(INV.store_week_demand(preds), params.inventory)
    plan = shared_table(INV.plan_rows(INV.plan_with_cap(series, params.inventory), params.inventory), "plan")
    naive = INV.naive_cost(series, params.inventory)
    _describe(spark, "routing", progress)
    depots = depot_frame(spark, params.routing.depots)
    stops = stops_from_predictions(spark, preds, params.routing.default_demand)
    routes = shared_table(RT.solve_routes(stops, depots, params.routing), "routes")
    naive_km = RT.naive_distance(RT.nearest_depot(stops, depots))
    _describe(spark, "scenarios", progress)
    s = params.scenario
    spike = SC.demand_spike(preds, plan, (s.spike_factor,), None, s, params.routing)
    delay = SC.supply_delay(preds, plan, (s.delay_days,), params.inventory)
    fail = SC.depot_failure(stops, depots, routes, (s.failed_depot,), s)
    return Results(model, metrics, importance, validation, preds, plan, naive, routes, naive_km,
                   SC.scenario_summary(spike, delay, fail), hist,
                   SC.scenario_errors(plan, depots, (s.failed_depot,)),
                   SC.scaled_routes(routes, s.spike_factor))
