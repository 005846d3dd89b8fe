import os
import tempfile

from pyspark.sql import functions as F

from stockroute.sources import io
from stockroute.sources import schemas as S


def _tmp():
    return tempfile.mkdtemp(prefix="stockroute-io-")


def test_csv_with_cr_line_ends_and_schema(spark):
    d = _tmp()
    path = os.path.join(d, "stores.csv")
    with open(path, "w", newline="") as f:
        f.write("Store,Type,Size\r1,A,151315\r2,A,202307\r3,B,37392\r")
    df = io.read_csv(spark, path, S.STORES_SCHEMA)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(1, "A", 151315), (2, "A", 202307), (3, "B", 37392)]


def test_csv_dates_and_export_roundtrip(spark):
    d = _tmp()
    src = os.path.join(d, "train.csv")
    with open(src, "w") as f:
        f.write("Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,24924.5,false\n"
                "1,1,2010-02-12,46039.49,true\n")
    df = io.read_csv(spark, src, S.SALES_SCHEMA)
    assert df.schema["Date"].dataType.typeName() == "date"
    out = os.path.join(d, "export")
    io.write_table(df, out, fmt="csv")
    back = io.read_csv(spark, out, S.SALES_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_optional_source_and_results_bundle(spark):
    d = _tmp()
    missing = io.read_optional(spark, os.path.join(d, "nope"), S.PLAN_SCHEMA)
    assert missing.count() == 0 and missing.schema == S.PLAN_SCHEMA
    plan = spark.createDataFrame([(1, 1, 10.0, 5.0, 20.0, 1.0, 5000.0, 5001.0, "optimal", True)], S.PLAN_SCHEMA)
    io.write_table(plan, os.path.join(d, "inventory_plan"))
    res = io.load_results(spark, d)
    assert res.inventory_plan.count() == 1 and res.routes.count() == 0


def test_json_records_and_model_persistence(spark):
    from stockroute.config import ForecastParams
    from stockroute.operators.forecast import feature_columns, fit_model
    d = _tmp()
    recs = spark.createDataFrame([("Demand Spike", "cost_increase", 1.5), ("Demand Spike", "x", None),
                                  ("Supply Delay", "y", 2.0)], S.SCENARIO_SCHEMA).coalesce(1)
    io.write_json_records(recs, os.path.join(d, "scen"))
    back = io.read_json_records(spark, os.path.join(d, "scen"), S.SCENARIO_SCHEMA)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, recs.collect()), key=repr)
    assert io.to_json_text(recs).first().json.startswith('{"scenario"')
    p = ForecastParams(n_estimators=2, max_depth=2)
    cols = feature_columns(p)
    rows = spark.range(60).select(*[(F.col("id") % 7).cast("double").alias(c) for c in cols],
                                  (F.col("id") * 3.0).alias("Weekly_Sales"),
                                  F.lit("train").alias("split"))
    model = fit_model(rows, p)
    io.save_model(model, os.path.join(d, "model"))
    loaded = io.load_model(os.path.join(d, "model"))
    assert loaded.stages[-1].getNumTrees == 2 and io.model_features(loaded) == cols


class _Run:
    """Tables of a run that all hold one number."""

    def __init__(self, spark, x: float):
        self.predictions = spark.createDataFrame([(1, 1, None, x)] * 3, S.RESULT_TABLES["predictions"])
        self.naive_cost = spark.createDataFrame([(1, x)], S.RESULT_TABLES["naive_cost"])
        self.naive_distance = spark.createDataFrame([(1, x, 1)], S.RESULT_TABLES["naive_distance"])


def _numbers(res):
    return ({r[3] for r in res.predictions.collect()}, {r[1] for r in res.naive_cost.collect()},
            {r[1] for r in res.naive_distance.collect()})


def test_a_run_that_breaks_off_leaves_the_last_one_whole(spark, tmp_path, monkeypatch):
    import pytest
    root, write = str(tmp_path), io.write_table
    first = io.save_results(_Run(spark, 1.0), root)
    assert _numbers(io.load_results(spark, root)) == ({1.0}, {1.0}, {1.0})

    def breaks(df, path, *a, **k):
        if path.endswith("naive_distance"):
            raise OSError("lost")
        write(df, path, *a, **k)
    monkeypatch.setattr(io, "write_table", breaks)
    with pytest.raises(OSError):
        io.save_results(_Run(spark, 2.0), root)
    monkeypatch.setattr(io, "write_table", write)
    # neither the broken run nor a mix of both
    assert _numbers(io.load_results(spark, root)) == ({1.0}, {1.0}, {1.0})
    third = io.save_results(_Run(spark, 3.0), root)
    assert _numbers(io.load_results(spark, root)) == ({3.0}, {3.0}, {3.0})
    assert _numbers(io.load_results(spark, root, run=first)) == ({1.0}, {1.0}, {1.0})
    assert [r.run for r in io.saved_runs(spark, root).orderBy("seq").collect()] == [first, third]
    with pytest.raises(ValueError, match="no run"):
        io.load_results(spark, root, run="other")


def test_old_runs_are_removed_and_cut_tables_noticed(spark, tmp_path):
    import glob
    import pytest
    root = str(tmp_path)
    names = [io.save_results(_Run(spark, float(k)), root, keep=2) for k in range(4)]
    assert {os.path.basename(p) for p in glob.glob(f"{root}/runs/*")} == set(names[2:])
    assert _numbers(io.load_results(spark, root, run=names[2])) == ({2.0}, {2.0}, {2.0})
    io.write_table(spark.createDataFrame([], S.RESULT_TABLES["naive_cost"]), f"{root}/runs/{names[3]}/naive_cost")
    with pytest.raises(ValueError, match="naive_cost .* not whole"):
        io.load_results(spark, root)
