from pyspark.sql import functions as F

from stockroute.config import ForecastParams, PlanningParams
from stockroute.plans import catalog as C
from stockroute.plans.runner import run_planning


def test_full_run_over_one_upload(spark, sf_small):
    params = PlanningParams(forecast=ForecastParams(n_estimators=5))
    upload = C.upload_table(spark, sf_small)
    steps = []
    res = run_planning(upload, params, progress=steps.append)
    assert steps == ["features", "forecast model", "forecast", "inventory", "routing", "scenarios"]
    n_series = res.predictions.select("Store", "Dept").distinct().count()
    assert res.predictions.count() == 13 * n_series > 0
    assert res.inventory_plan.where(F.col("Inventory_Level") < 0).count() == 0
    routes = res.routes.toPandas()
    assert routes[~routes.Is_Depot].stop_id.is_unique
    scen = {r.scenario.split(" ")[0] for r in res.scenarios.collect()}
    assert scen == {"Demand", "Supply", "Warehouse"}
    assert {r.split for r in res.metrics.collect()} == {"train", "val"}


def test_counts_come_with_the_write(spark, sf_small, monkeypatch):
    """The write's own figures equal those of a scan, and the fit needs no count."""
    from stockroute.operators import forecast as FC
    from stockroute.session import counted_table
    hist = C.ml_history(spark, sf_small)
    table, seen = counted_table(hist, "seen", last=F.max("Date"), stores=F.max("Store"))
    want = hist.agg(F.count("*").alias("rows"), F.max("Date").alias("last"), F.max("Store").alias("stores")).first()
    assert seen == want.asDict() and table.count() == want.rows
    p = ForecastParams(n_estimators=2)
    frame = FC.prepare_model_frame(table, p)
    counted = []
    monkeypatch.setattr(type(hist), "count", lambda self, f=type(hist).count: counted.append(1) or f(self))
    FC.fit_model(frame, p, rows=seen["rows"])
    assert not counted
    FC.fit_model(frame, p)
    assert len(counted) == 1


def test_upload_validation_rejects_missing_columns(spark, sf_small):
    import pytest
    upload = C.upload_table(spark, sf_small).drop("CPI")
    with pytest.raises(ValueError, match="columns not found: CPI"):
        run_planning(upload)


def test_stores_beyond_the_sample_are_kept(spark):
    from stockroute.plans.runner import stops_from_predictions
    pred = spark.createDataFrame([(0, 5.0), (1, 2.0), (1, 3.0), (46, None)], "Store int, Predicted_Weekly_Sales double")
    got = {r.stop_id: (r.stop_name, r.lat, r.demand) for r in stops_from_predictions(spark, pred, 7.0).collect()}
    assert set(got) == {0, 1, 46}
    assert got[0] == ("Store 0", 39.8, 5.0) and got[46] == ("Store 46", 39.8, 7.0)
    assert got[1][2] == 5.0 and got[1][0] != "Store 1"


def test_saved_run_can_be_read_again(spark, sf_small, tmp_path):
    from stockroute.operators.forecast import score
    from stockroute.sources import io, schemas
    params = PlanningParams(forecast=ForecastParams(n_estimators=3))
    res = run_planning(C.upload_table(spark, sf_small), params)
    io.save_results(res, str(tmp_path))
    back = io.load_results(spark, str(tmp_path), with_model=True)
    for name in schemas.RESULT_TABLES:
        a, b = (sorted(map(tuple, getattr(x, name).collect()), key=repr) for x in (res, back))
        assert len(b) == len(a) > 0, name
        if name in ("predictions", "inventory_plan", "feature_importance", "validation"):
            assert a == b, name
    assert io.model_features(back.model)[0] == "Store"
    from stockroute.operators.forecast import prepare_model_frame
    frame = prepare_model_frame(res.history, params.forecast).limit(50).cache()
    x, y = (sorted(r.prediction for r in score(m, frame, params.forecast).collect()) for m in (res.model, back.model))
    assert x == y
