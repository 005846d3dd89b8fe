import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockroute.config import ForecastParams
from stockroute.operators import forecast as FC
from stockroute.plans import catalog as C


@pytest.fixture(scope="module")
def fitted(spark, sf_small):
    model, frame = C.fitted(spark, sf_small)
    return model, frame, C.ml_history(spark, sf_small)


def test_forecasts_cover_eligible_series(spark, fitted):
    model, _, hist = fitted
    p = C._params().forecast
    direct = FC.forecast_direct(model, hist, p)
    rec = FC.forecast_recursive(model, hist, p)
    eligible = hist.groupBy("Store", "Dept").count().where(F.col("count") >= p.min_history).count()
    for df in (direct, rec):
        per = df.groupBy("Store", "Dept").count().collect()
        assert len(per) == eligible and all(r["count"] == p.horizon for r in per)
        assert df.where(F.col("Predicted_Weekly_Sales") < 0).count() == 0
    last = hist.agg(F.max("Date")).first()[0]
    first_week = direct.agg(F.min("Date")).first()[0]
    assert (first_week - last).days == 7
    j = direct.join(rec.withColumnRenamed("Predicted_Weekly_Sales", "r"), ["Store", "Dept", "Date"])
    wk1 = j.where(F.col("Date") == first_week)
    assert wk1.where(F.abs(F.col("r") - F.col("Predicted_Weekly_Sales")) > 1e-9).count() == 0


def test_frozen_lags_do_not_move(spark, fitted):
    model, _, hist = fitted
    p = C._params().forecast
    st = FC._step_features(FC.series_state(hist, p), p).toPandas()
    h = hist.toPandas().sort_values(["Store", "Dept", "Date"])
    for (s, d), g in list(h.groupby(["Store", "Dept"]))[:5]:
        y = g.Weekly_Sales.to_numpy()
        if len(y) < p.min_history:
            continue
        row = st[(st.Store == s) & (st.Dept == d)].iloc[0]
        for k in p.lags:
            assert row[f"Sales_Lag_{k}"] == pytest.approx(y[len(y) - k])
        assert row.Sales_RollingMean_4 == pytest.approx(y[-4:].mean())
        assert row.Sales_RollingMean_12 == pytest.approx(y[-12:].mean())
        assert row.Sales_RollingStd_4 == pytest.approx(y[-4:].std())      # population std


def test_short_series_lag_fallback(spark):
    p = ForecastParams(lags=(1, 8), min_history=3)
    pdf = pd.DataFrame({"Store": [1] * 4, "Dept": [1] * 4,
                        "Date": pd.date_range("2012-01-02", periods=4, freq="7D").date,
                        "Weekly_Sales": [10.0, 20.0, 30.0, 40.0]})
    df = spark.createDataFrame(pdf, "Store int, Dept int, Date date, Weekly_Sales double")
    st = FC._step_features(FC.series_state(df, p), p).first()
    assert st.Sales_Lag_1 == 40.0 and st.Sales_Lag_8 == 10.0        # falls back to the first value
    assert st.Sales_RollingStd_4 == pytest.approx(np.std([10, 20, 30, 40]))


def test_metrics_and_importance(spark, fitted):
    model, frame, _ = fitted
    metrics, val = FC.evaluate(model, frame, C._params().forecast)
    rows = {r.split: r for r in metrics.collect()}
    assert set(rows) == {"train", "val"} and rows["val"].n == val.count()
    imp = FC.feature_importance(model, C._params().forecast).collect()
    assert len(imp) == len(FC.feature_columns(C._params().forecast))
    assert sum(r.importance for r in imp) == pytest.approx(1.0, abs=1e-6)


def test_flat_trees_equal_the_model_on_every_row(spark, fitted):
    model, frame, _ = fitted
    cols = FC.feature_columns(C._params().forecast)
    rows = model.transform(FC._assembled(frame, cols)).select(*cols, "prediction").toPandas()
    ensemble = FC.trees.flat(model.stages[-1])
    assert len(ensemble.root) == len(model.stages[-1].trees) and ensemble.depth <= 4
    got = ensemble.predict(rows[cols].to_numpy(float))
    assert len(rows) > 1000 and np.allclose(got, rows.prediction, rtol=1e-12, atol=1e-9)


def test_one_stage_equals_week_by_week(spark, fitted):
    model, _, hist = fitted
    p = C._params().forecast
    a = FC.forecast_recursive(model, hist, p)
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    key = ["Store", "Dept", "Date"]
    a, b = (df.toPandas().sort_values(key).reset_index(drop=True) for df in (a, FC.forecast_by_steps(model, hist, p)))
    assert a[key].equals(b[key]) and len(a) > 100
    # a cent may round differently
    assert (a.Predicted_Weekly_Sales - b.Predicted_Weekly_Sales).abs().max() < 0.011


def test_descriptions_of_trees():
    text = """GBTRegressionModel: uid=x, numTrees=2, numFeatures=3
  Tree 0 (weight 1.0):
    If (feature 2 <= 1.5)
     If (feature 0 <= -3.0E-4)
      Predict: 10.0
     Else (feature 0 > -3.0E-4)
      Predict: 20.0
    Else (feature 2 > 1.5)
     Predict: -1.0E10
  Tree 1 (weight 0.1):
    Predict: 5.0
"""
    got = FC.trees.parse(text).predict(np.array([[-1.0, 0, 1.5], [0.0, 0, 1.0], [0.0, 0, 2.0], [0.0, 0, np.nan]]))
    assert got.tolist() == [10.5, 20.5, -1e10 + 0.5, -1e10 + 0.5]
    with pytest.raises(ValueError):
        FC.trees.parse("Tree 0 (weight 1.0):\n If (feature 1 in {0.0})\n Predict: 1.0")


@pytest.mark.parametrize("n, splits", [(9, False), (10, True)])
def test_nodes_of_under_ten_rows_are_not_split(spark, n, splits):
    """Five rows a leaf, so a node of nine can't be parted."""
    p = ForecastParams(n_estimators=1, max_depth=2, subsample=1.0)
    cols = FC.feature_columns(p)
    rows = spark.range(n).select(*[(F.col("id") if c == "Size" else F.lit(0)).cast("double").alias(c) for c in cols],
                                 F.when(F.col("id") < n // 2, 0.0).otherwise(100.0).alias("Weekly_Sales"),
                                 F.lit("train").alias("split"))
    depth = FC.trees.flat(FC.fit_model(rows, p).stages[-1]).depth
    assert (depth > 0) == splits


def test_split_rule_beyond_the_leaves_is_refused(spark):
    with pytest.raises(ValueError, match="min_split"):
        FC.fit_model(spark.range(1), ForecastParams(min_leaf=2, min_split=10))
