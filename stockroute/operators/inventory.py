"""Inventory planning (J1-J7) as column expressions over grouped series.

The planning application solves a small mixed-integer programme per store:
minimise  h * sum(inv_t) + K * #orders  subject to
inv_t = inv_{t-1} + order_t - d_t,  inv_t >= safety,  inv_0 = 1.5 * safety.

With C_t the cumulative demand and z0 = inv_0 - safety, the cumulative orders
O_t must cover D_t = max(0, max_{k<=t} C_k - z0).  The net demands
n_t = D_t - D_{t-1} >= 0 turn the programme into uncapacitated lot sizing,
which the Wagner-Whitin recursion solves exactly; it runs here on a convex
hull of lines, as Spark higher-order functions over one array per store (the
horizon bounds the array).  Where that optimum would break the order cap, the
capacitated problem is solved exactly by a fold over undominated states.  The
order-up-to-safety fallback has the closed form
inv_t = max(inv_0, safety + max_{j<=t} C_j) - C_t, by array folds too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroute.config import InventoryParams
from stockroute.functions.columns import fixed_cost


def store_week_demand(pred: DataFrame, keys=("Store",), date_col: str = "Date",
                      value: str = "Predicted_Weekly_Sales") -> DataFrame:
    """total demand per store and week (partial aggregation before the shuffle)."""
    return pred.groupBy(*keys, date_col).agg(F.sum(value).alias("Total_Demand"))


def demand_series(store_demand: DataFrame, p: InventoryParams = InventoryParams(),
                  keys=("Store",), date_col: str = "Date") -> DataFrame:
    """One row per store with the ordered demand array, safety stock
    and initial stock; stores with fewer than ``min_periods`` weeks dropped."""
    s = (store_demand.groupBy(*keys)
         .agg(F.sort_array(F.collect_list(F.struct(F.col(date_col).alias("d"),
                                                    F.col("Total_Demand").alias("q"))))
              .alias("_s"))
         .withColumn("demand", F.transform("_s", lambda x: x["q"]))
         .withColumn("T", F.size("demand"))
         .where(F.col("T") >= p.min_periods)
         .drop("_s"))
    mean = F.aggregate("demand", F.lit(0.0), lambda a, x: a + x) / F.col("T")
    return s.withColumn("safety", mean * F.lit(float(p.safety_weeks))) \
            .withColumn("initial", F.col("safety") * F.lit(p.initial_factor))


def _running(arr: Column, start: Column, merge) -> Column:
    """Array of the fold's values after each element: one step an element."""
    return F.aggregate(arr, F.struct(start.alias("now"), F.array().cast("array<double>").alias("all")),
                       lambda a, x: F.struct(merge(a["now"], x).alias("now"),
                                             F.concat(a["all"], F.array(merge(a["now"], x))).alias("all")))["all"]


def _prefix_sums(arr: Column) -> Column:
    return _running(arr, F.lit(0.0), lambda a, x: a + x)


def _prefix_max(arr: Column) -> Column:
    return _running(arr, F.lit(float("-inf")), lambda a, x: F.greatest(a, x))


def _total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def _to_cover(series: DataFrame) -> DataFrame:
    """``_C``, the cumulative demand, and ``_D``, the cumulative orders it calls for."""
    out = series.withColumn("_C", _prefix_sums(F.col("demand")))
    z0 = F.col("initial") - F.col("safety")
    return out.withColumn("_D", F.transform(_prefix_max(F.col("_C")), lambda c: F.greatest(c - z0, F.lit(0.0))))


def _levels(orders: Column) -> Column:
    return F.transform(F.arrays_zip(_prefix_sums(orders).alias("o"), F.col("_C").alias("c")),
                       lambda x: F.col("initial") + x["o"] - x["c"])


_HULL = "array<struct<start:int,cost:double,since:double>>"


def lot_size(series: DataFrame, p: InventoryParams = InventoryParams()) -> DataFrame:
    """Exact minimum-cost order plan per store (Wagner-Whitin on a convex hull).

    Returns the series row with an ``orders`` array, ``levels`` array and an
    ``exact`` flag that is false when a single order would exceed
    ``max_order`` (the cap is then binding and the result is the uncapped
    optimum, flagged for review).
    """
    h, K = F.lit(float(p.holding_cost)), F.lit(float(p.ordering_cost))
    out = _to_cover(series)
    # weeks with their net demand, and the running sums of net demand (N, ``need``) and of
    # week x net demand (M, ``moment``)
    net = F.transform("_D", lambda x, i: F.when(i == 0, x).otherwise(x - F.element_at(F.col("_D"), i)))
    out = out.withColumn("_n", net)
    moment = F.transform("_n", lambda x, i: x * (i + 1))
    out = out.withColumn("_w", F.transform(
        F.arrays_zip(F.col("_n").alias("net"), F.col("_D").alias("need"), _prefix_sums(moment).alias("moment")),
        lambda x, i: F.struct((i + 1).alias("t"), x["net"].alias("net"), x["need"].alias("need"), x["moment"].alias("moment"))))

    # The plan up to week t whose last order comes in week j costs
    #   f[j-1] + K + h sum_{k=j..t} (k-j) n_k = K + h M_t + (b_j - h j N_t),
    #   b_j = f[j-1] - h M_{j-1} + h j N_{j-1}.
    # So each start week is a line in N_t.  N never falls and later lines are steeper,
    # so the hull of lines is a queue: ``since`` is the N from which a line is the
    # cheapest; a new line drops those that it undercuts where they begin, and lines
    # before the cheapest one at N_t are never needed again.  A week without net demand
    # is free.
    value = lambda line, x: line["cost"] - h * line["start"] * x

    def step(acc, w):
        line = F.struct(w["t"].cast("int").alias("start"), (
            acc["f"] - h * acc["moment"] + h * w["t"] * acc["need"]).alias("cost"))
        kept = F.filter(acc["hull"], lambda s: value(line, F.greatest(s["since"], acc["need"]))
                        > value(s, F.greatest(s["since"], acc["need"])))
        last = F.try_element_at(kept, F.lit(-1))
        since = F.when(last.isNull(), acc["need"]).otherwise(
            F.greatest((line["cost"] - last["cost"]) / (h * (line["start"] - last["start"])), acc["need"]))
        added = F.concat(kept, F.array(F.struct(line["start"], line["cost"], since.alias("since"))).cast(_HULL))
        later = F.filter(added, lambda s: s["since"] > w["need"])
        queue = F.slice(added, F.greatest(F.size(added) - F.size(later), F.lit(1)), F.size(later) + 1)
        best = F.element_at(queue, 1)
        ordered = K + h * w["moment"] + value(best, w["need"])
        free = (w["net"] <= 0) & (acc["f"] <= ordered)
        return F.struct(F.when(free, acc["f"]).otherwise(ordered).alias("f"), w["need"].alias("need"), w["moment"].alias("moment"),
                        queue.alias("hull"), F.concat(acc["from"], F.array(
                            F.when(free, F.lit(0)).otherwise(best["start"]))).alias("from"))

    init = F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("need"), F.lit(0.0).alias("moment"),
                    F.array().cast(_HULL).alias("hull"), F.array().cast("array<int>").alias("from"))
    out = out.withColumn("_from", F.aggregate("_w", init, step)["from"])

    # back from the last week: an order in week j covers the net demand up to the week
    # it was reached from; one step a week
    def back(st, w):
        start = F.element_at(F.col("_from"), w["t"])
        reached = st["t"] == w["t"]
        quantity = w["need"] - F.when(start > 1, F.element_at(F.col("_D"), F.greatest(start - 1, F.lit(1)))).otherwise(F.lit(0.0))
        j = F.when(reached, start).otherwise(st["j"])
        q = F.when(reached, quantity).otherwise(st["q"])
        return F.struct(
            F.when(reached, F.when(start == 0, w["t"] - 1).otherwise(start - 1)).otherwise(st["t"]).alias("t"),
            j.alias("j"), q.alias("q"),
            F.concat(st["o"], F.array(F.when(j == w["t"], q).otherwise(F.lit(0.0)))).alias("o"))

    start = F.struct(F.col("T").alias("t"), F.lit(0).alias("j"), F.lit(0.0).alias("q"),
                     F.array().cast("array<double>").alias("o"))
    out = out.withColumn("orders", F.reverse(F.aggregate(F.reverse("_w"), start, back)["o"]))
    out = out.withColumn("levels", _levels(F.col("orders")))
    placed = F.size(F.filter(F.array_distinct(F.filter("_from", lambda j: j > 0)), lambda j: F.element_at(
        F.col("orders"), j) > 0))
    return (out.withColumn("plan_cost", h * _total(F.col("levels")) + K * placed)
            .withColumn("exact", F.array_max("orders") <= F.lit(float(p.max_order)))
            .drop("_C", "_D", "_n", "_w", "_from"))


def order_up_to(series: DataFrame) -> DataFrame:
    """Fallback policy, order just enough to keep the safety stock.

    inv_t = max(inv_0, safety + max_{j<=t} C_j) - C_t  (exact for any sign of
    demand);  order_t = max(0, d_t + safety - inv_{t-1}), exactly 0 in weeks
    without an order (shortfalls below 1e-9 x safety count as float noise).
    """
    C = _prefix_sums(F.col("demand"))
    out = series.withColumn("_C", C)
    levels = F.transform(_prefix_max(F.col("_C")), lambda m, i:
                         F.greatest(F.col("initial"), F.col("safety") + m)
                         - F.element_at(F.col("_C"), i + 1))
    out = out.withColumn("levels", levels)
    prev = lambda i: F.when(i == 0, F.col("initial")).otherwise(F.element_at(F.col("levels"), i))
    # shortfalls within float noise of zero are not orders (no fixed cost)
    eps = F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs(F.col("safety")))
    raw = lambda d, i: d + F.col("safety") - prev(i)
    orders = F.transform(F.col("demand"), lambda d, i: F.when(raw(d, i) > eps, raw(d, i))
                         .otherwise(F.lit(0.0)))
    return out.withColumn("orders", orders).drop("_C")


_STATES = "array<struct<level:double,cost:double,orders:array<double>>>"


def _capped_orders(p: InventoryParams, cap: Column) -> Column:
    """J2 with a binding cap: the cheapest orders of at most ``cap`` a week (from ``_D``),
    or null if no plan keeps the safety stock.

    The weeks are folded from the last one back.  A state is a cumulative order level
    before which everything is still open, with the cost and the orders of the weeks
    behind it.  An order in week t leaves max(D_{t-1}, level - cap), no order leaves the
    level.  What is left to pay never falls with the level, so a state that another one
    undercuts in level and cost is dropped; the few others are kept by rising level.
    """
    h, K = F.lit(float(p.holding_cost)), F.lit(float(p.ordering_cost))
    need = F.col("_D")

    def step(states, t):
        before = F.when(t > 1, F.element_at(need, F.greatest(t - 1, F.lit(1)))).otherwise(F.lit(0.0))

        def ways(s):
            held = s["cost"] + h * s["level"]
            lower = F.greatest(before, s["level"] - cap)
            rest = F.struct(F.greatest(s["level"], before).alias("level"), held.alias("cost"),
                            F.concat(F.array(F.lit(0.0)), s["orders"]).alias("orders"))
            order = F.struct(lower.alias("level"), (held + K).alias("cost"),
                             F.concat(F.array(s["level"] - lower), s["orders"]).alias("orders"))
            return F.when(s["level"] > before, F.array(rest, order)).otherwise(F.array(rest)).cast(_STATES)

        both = F.array_sort(F.flatten(F.transform(states, ways)))
        return F.aggregate(both, F.array().cast(_STATES), lambda kept, s: F.when(
            (F.size(kept) == 0) | (s["cost"] < F.try_element_at(kept, F.lit(-1))["cost"]), F.concat(kept, F.array(s)))
            .otherwise(kept))

    end = F.array(F.struct(F.element_at(need, -1).alias("level"), F.lit(0.0).alias("cost"),
                           F.array().cast("array<double>").alias("orders"))).cast(_STATES)
    states = F.aggregate(F.reverse(F.sequence(F.lit(1), F.size(need))), end, step)
    # the first state is the lowest one, and only level 0 is paid off
    lowest = F.get(states, 0)
    return F.when(lowest["level"] <= 0, lowest["orders"])


def plan_with_cap(series: DataFrame, p: InventoryParams = InventoryParams(),
                  cap: Column | None = None) -> DataFrame:
    """The cheapest plan with no order above the cap (``max_order``, or a
    column of its own per series); ``method`` tells how it was found.

    ``optimal``: lot sizing, its orders within the cap; ``optimal_capped``: the
    capacitated recursion; ``order_up_to``: no plan within the cap keeps the
    safety stock, so the uncapped fallback policy is used (``feasible`` false).
    """
    cap = F.lit(float(p.max_order)) if cap is None else cap.cast("double")
    keep = series.columns
    ww = _to_cover(lot_size(series, p).withColumn("exact", F.array_max("orders") <= cap))
    ww = ww.withColumn("_capped", F.when(~F.col("exact"), _capped_orders(p, cap)))
    ww = ww.withColumn("_capped_levels", F.when(F.col("_capped").isNotNull(), _levels(F.col("_capped"))))
    both = order_up_to(ww.select(*keep, "exact", "_capped", "_capped_levels", F.col("orders").alias("_ww"),
                                 F.col("levels").alias("_wl")))
    found = F.col("_capped").isNotNull()
    return both.select(
        *keep,
        F.when(F.col("exact"), F.col("_ww")).when(found, F.col("_capped")).otherwise(F.col("orders")).alias("orders"),
        F.when(F.col("exact"), F.col("_wl")).when(found, F.col("_capped_levels")).otherwise(F.col("levels"))
        .alias("levels"),
        F.when(F.col("exact"), F.lit("optimal")).when(found, F.lit("optimal_capped"))
        .otherwise(F.lit("order_up_to")).alias("method"),
        (F.col("exact") | found).alias("feasible"))


def plan_rows(planned: DataFrame, p: InventoryParams = InventoryParams(), keys=("Store",),
              order_threshold: float = 0.01, rounded: bool = False) -> DataFrame:
    """One row per (store, week) with period costs.

    ``order_threshold`` is 0.01 for the optimised plan and 0 for the fallback
    policy, as in the application.  ``rounded`` rounds each row to 2 decimals
    like the application's stored plan.  ``method`` and ``feasible`` of
    ``plan_with_cap`` are kept.
    """
    told = [c for c in ("method", "feasible") if c in planned.columns]
    z = F.arrays_zip(F.col("demand").alias("Demand"), F.col("orders").alias("Optimal_Order"),
                     F.col("levels").alias("Inventory_Level"))
    rows = planned.select(*keys, *told, F.posexplode(z).alias("pos", "r"))
    h = F.lit(float(p.holding_cost))
    K = F.lit(float(p.ordering_cost))
    order = F.col("r.Optimal_Order")
    oc = (fixed_cost(order, K) if order_threshold > 0
          else F.when(order > 0, K).otherwise(F.lit(0.0)))
    out = rows.select(
        *keys, (F.col("pos") + 1).alias("Week"),
        F.col("r.Demand").alias("Demand"), order.alias("Optimal_Order"),
        F.col("r.Inventory_Level").alias("Inventory_Level"),
        (h * F.col("r.Inventory_Level")).alias("Holding_Cost"), oc.alias("Ordering_Cost"),
        (h * F.col("r.Inventory_Level") + oc).alias("Total_Cost"), *told)
    if rounded:
        out = out.withColumns({c: F.bround(c, 2) for c in (
            "Demand", "Optimal_Order", "Inventory_Level", "Holding_Cost", "Ordering_Cost",
            "Total_Cost")})
    return out


def optimise_inventory(pred: DataFrame, p: InventoryParams = InventoryParams(),
                       rounded: bool = False) -> DataFrame:
    """All-store plan from predictions (F1 -> D5 -> J2 -> J4)."""
    series = demand_series(store_week_demand(pred), p)
    return plan_rows(plan_with_cap(series, p), p, rounded=rounded)


def naive_cost(series: DataFrame, p: InventoryParams = InventoryParams(),
               keys=("Store",)) -> DataFrame:
    """Order every week and hold safety + half the week's demand."""
    total = F.aggregate("demand", F.lit(0.0), lambda a, x: a + x)
    cost = (F.col("T") * F.lit(float(p.ordering_cost))
            + F.lit(float(p.holding_cost)) * (F.col("T") * F.col("safety") + F.lit(0.5) * total))
    return series.select(*keys, cost.alias("naive_cost"))


def plan_summary(plan: DataFrame) -> DataFrame:
    """total cost, orders placed, mean inventory level."""
    return plan.agg(F.sum("Total_Cost").alias("total_cost"),
                    F.count(F.when(F.col("Optimal_Order") > 0, 1)).alias("orders_placed"),
                    F.avg("Inventory_Level").alias("avg_inventory"))


def savings(naive_total: Column, plan_total: Column) -> dict[str, Column]:
    """Savings and savings percent (guarded)."""
    sv = naive_total - plan_total
    return {"savings": sv,
            "savings_pct": F.when(naive_total > 0, sv / naive_total * 100).otherwise(F.lit(0.0)),
            "savings_non_negative": F.greatest(F.lit(0.0), sv)}


def store_plan_kpis(plan: DataFrame) -> DataFrame:
    """per-store cost, orders, mean level and mean positive order size."""
    return plan.groupBy("Store").agg(
        F.sum("Total_Cost").alias("total_cost"),
        F.sum("Holding_Cost").alias("holding_cost"),
        F.sum("Ordering_Cost").alias("ordering_cost"),
        F.count(F.when(F.col("Optimal_Order") > 0, 1)).alias("orders_placed"),
        F.avg("Inventory_Level").alias("avg_inventory"),
        F.avg(F.when(F.col("Optimal_Order") > 0, F.col("Optimal_Order"))).alias("avg_order_size"))
