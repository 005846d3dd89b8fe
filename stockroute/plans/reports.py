"""Dashboard queries (M1-M8) over the tables of a planning run.

Every report is an aggregate or a filtered projection; nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroute.operators.forecast import history_and_forecast
from stockroute.operators.inventory import store_plan_kpis
from stockroute.operators.routing import distance_savings, fleet_distance, route_summary


def headline_kpis(metrics: DataFrame, plan: DataFrame, routes: DataFrame) -> DataFrame:
    """M1: validation MAE and R^2, plan cost and fleet distance in one row."""
    val = metrics.where(F.col("split") == "val")
    return (val.select(F.col("mae").alias("val_mae"), F.col("r2").alias("val_r2"))
            .withColumn("plan_cost", F.coalesce(plan.agg(F.sum("Total_Cost")).scalar(),
                                                F.lit(0.0)))
            .withColumn("fleet_km", F.coalesce(fleet_distance(routes)
                                               .agg(F.sum("fleet_km")).scalar(), F.lit(0.0))))


def cost_comparison(naive: DataFrame, plan: DataFrame) -> DataFrame:
    """Naive versus optimised inventory cost."""
    from stockroute.operators.inventory import savings
    t = naive.agg(F.sum("naive_cost").alias("naive_cost")).withColumn(
        "optimised_cost", F.coalesce(plan.agg(F.sum("Total_Cost")).scalar(), F.lit(0.0)))
    sv = savings(F.col("naive_cost"), F.col("optimised_cost"))
    return t.select("naive_cost", "optimised_cost", sv["savings_non_negative"].alias("savings"),
                    sv["savings_pct"].alias("savings_pct"))


def distance_comparison(assigned: DataFrame, routes: DataFrame, by=("plan_id",)):
    """Naive round trips versus routed fleet distance per plan, plus
    the like-for-like naive distance over the stops the routes served.

    ``assigned`` is the output of ``routing.nearest_depot``.  Returns
    (comparison, served stops).
    """
    from stockroute.operators.routing import naive_distance
    served = routes.where(~F.col("Is_Depot")).select(*by, "stop_id").distinct()
    naive = naive_distance(assigned, by=by)
    naive_served = (assigned.join(served, [*by, "stop_id"], "left_semi")
                    .groupBy(*by).agg((2 * F.sum("depot_dist")).alias("naive_served_km")))
    fleet = fleet_distance(routes, by=by).select(*by, "fleet_km")
    j = (naive.join(fleet, list(by), "left").join(naive_served, list(by), "left")
         .fillna({"fleet_km": 0.0, "naive_served_km": 0.0}))
    sv = distance_savings(F.col("naive_km"), F.col("fleet_km"))
    out = j.select(*by, "naive_km", "fleet_km", "naive_served_km",
                   sv["saved_km_non_negative"].alias("saved_km"), sv["saved_pct"].alias("saved_pct"))
    return out, served


def series_view(history: DataFrame, predictions: DataFrame, store: int, dept: int) -> DataFrame:
    """One series' history and forecast on one axis."""
    both = history_and_forecast(history, predictions)
    return both.where((F.col("Store") == store) & (F.col("Dept") == dept)).orderBy("Date")


def store_plan_view(plan: DataFrame, store: int) -> DataFrame:
    """M5: schedule, demand vs level and cost breakdown of one store."""
    rows = plan.where(F.col("Store") == store).orderBy("Week")
    kpis = store_plan_kpis(plan.where(F.col("Store") == store))
    return rows, kpis


def fleet_summary(routes: DataFrame) -> DataFrame:
    """Per vehicle stops (max stop order, incl. the return leg),
    distance and load, plus totals per plan."""
    per_v = route_summary(routes)
    return per_v.select("plan_id", "Vehicle", F.col("max_stop_order").alias("stops"),
                        F.col("total_distance").alias("distance_km"),
                        F.col("total_load").alias("load"), "num_stops")


def scenario_cards(summary: DataFrame, scenario: str) -> DataFrame:
    """M7: the metric rows of one scenario."""
    return summary.where(F.col("scenario").startswith(scenario))


def actual_vs_predicted(validation: DataFrame, store: int, dept: int) -> DataFrame:
    """M8: validation rows of one series."""
    return validation.where((F.col("Store") == store) & (F.col("Dept") == dept)).orderBy("Date")


def with_labels(df: DataFrame, store_names: DataFrame, dept_names: DataFrame) -> DataFrame:
    """Store and department labels by lookup (constant dims)."""
    from stockroute.functions.columns import label
    out = df.join(store_names, "Store", "left")
    if "Dept" in df.columns:
        out = out.join(dept_names, "Dept", "left") \
                 .withColumn("dept_label", label("Dept", F.col("Dept"), F.col("Dept_Name"))) \
                 .drop("Dept_Name")
    return out.withColumn("store_label", label("Store", F.col("Store"), F.col("Store_Name"))) \
              .drop("Store_Name")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """H4: head preview (the limit is the feature)."""
    return df.limit(n)


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """H3/H4: top-k rows by a column (the limit is the feature)."""
    return df.orderBy(F.col(col).desc()).limit(k)
