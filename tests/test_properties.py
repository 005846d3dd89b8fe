"""Property tests (hypothesis): many random series per example, one Spark job each."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockroute.operators.inventory import lot_size, order_up_to, plan_rows
from tests.test_inventory import P, _brute, _series_frame

demand = st.one_of(st.just(0.0), st.floats(min_value=0.0, max_value=80000.0, allow_nan=False))
series_list = st.lists(st.lists(demand, min_size=2, max_size=7), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None)
@given(series_list)
def test_lot_sizing_optimal_and_feasible(spark, series):
    series = [[round(x, 2) for x in d] for d in series]
    planned = lot_size(_series_frame(spark, series), P)
    got = {r.Store: (r.plan_cost, r.safety) for r in planned.select("Store", "plan_cost", "safety").collect()}
    for i, d in enumerate(series):
        assert got[i][0] == pytest.approx(_brute(d), rel=1e-9, abs=1e-6)
    rows = plan_rows(planned, P).toPandas()
    for s, g in rows.groupby("Store"):
        assert (g.Inventory_Level >= got[s][1] - 1e-6).all()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.floats(min_value=-5000.0, max_value=80000.0, allow_nan=False),
                         min_size=2, max_size=15), min_size=1, max_size=12))
def test_order_up_to_keeps_safety_and_balance(spark, series):
    series = [[round(x, 2) for x in d] for d in series]
    rows = plan_rows(order_up_to(_series_frame(spark, series)), P, order_threshold=0.0).toPandas()
    for i, d in enumerate(series):
        g = rows[rows.Store == i].sort_values("Week")
        s = float(np.mean(d))
        init = 1.5 * s
        assert (g.Inventory_Level >= s - 1e-6 * max(1.0, abs(s))).all()
        lvl = init + (g.Optimal_Order - g.Demand).cumsum()
        assert np.allclose(lvl, g.Inventory_Level, atol=1e-6)
