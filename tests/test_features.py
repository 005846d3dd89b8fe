import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockroute.operators import aggregates as A
from stockroute.operators import features as F_
from stockroute.operators.features import lag_features, time_split
from stockroute.operators.validate import missing_columns, validate_upload
from stockroute.sources.schemas import empty_frame


def _panel(spark, n=30, series=3, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(series):
        for t in range(n if s else 1):                      # series 0 has one row
            rows.append((s, 1, pd.Timestamp("2011-01-03") + pd.Timedelta(weeks=t),
                         float(rng.normal(1000, 300))))
    pdf = pd.DataFrame(rows, columns=["Store", "Dept", "Date", "Weekly_Sales"])
    pdf["Date"] = pdf["Date"].dt.date
    return pdf, spark.createDataFrame(pdf, "Store int, Dept int, Date date, Weekly_Sales double")


def test_lag_features_match_pandas(spark):
    pdf, df = _panel(spark)
    got = lag_features(df).toPandas().sort_values(["Store", "Dept", "Date"]).reset_index(drop=True)
    exp = pdf.sort_values(["Store", "Dept", "Date"]).reset_index(drop=True)
    g = exp.groupby(["Store", "Dept"])["Weekly_Sales"]
    for k in (1, 2, 4, 8, 12):
        assert np.allclose(got[f"Sales_Lag_{k}"], g.shift(k), equal_nan=True)
    for _, rows in got.groupby(["Store", "Dept"]):
        past: list[float] = []
        for r in rows.itertuples():
            for width, name in ((4, "Sales_RollingMean_4"), (12, "Sales_RollingMean_12")):
                window = past[-width:]
                value = getattr(r, name)
                assert np.isnan(value) if not window else value == pytest.approx(sum(window) / len(window))
            window = past[-4:]
            mid = sum(window) / len(window) if window else 0.0
            spread = (sum((x - mid) ** 2 for x in window) / (len(window) - 1)) ** 0.5 if len(window) > 1 else 0.0
            assert r.Sales_RollingStd_4 == pytest.approx(spread)
            past.append(r.Weekly_Sales)
    # one-row trailing sample std -> 0 after coalesce
    assert got.loc[got.Store == 0, "Sales_RollingStd_4"].iloc[0] == 0.0


def test_time_split_cutoff(spark):
    _, df = _panel(spark)
    out = time_split(df, 13).groupBy("split").agg(F.count("*").alias("n")).collect()
    counts = {r.split: r.n for r in out}
    assert counts["val"] == 2 * 13


def test_exact_median_refinement(spark, monkeypatch):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=5001).tolist() + [None] * 10
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    monkeypatch.setattr(A, "BRACKET_VALUES", 4)             # several sketches
    got = A.exact_medians(df, ["x"])["x"]
    assert got == float(np.median([v for v in vals if v is not None]))
    df2 = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert A.exact_medians(df2, ["x"])["x"] == 2.5


def test_median_of_ties_collects_a_few_counts_only(spark, monkeypatch):
    """Nine in ten values are equal: no pass may return more rows than a bracket may hold."""
    vals = [5.0] * 18000 + np.random.default_rng(1).uniform(0, 10, 2000).tolist()
    df = spark.createDataFrame([(v, v * 2, 1e9 * (i % 2)) for i, v in enumerate(vals)], "x double, y double, z double")
    monkeypatch.setattr(A, "BRACKET_VALUES", 8)
    collected = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: collected.append(r := collect(self)) or r)
    got = A.exact_medians(df, ["x", "y", "z"])
    assert got == {"x": 5.0, "y": 10.0, "z": 5e8}
    assert max(map(len, collected)) <= 3 * (8 + 2)


def test_histogram_of_a_constant(spark):
    r = A.histogram(spark.createDataFrame([(3.0,)] * 4 + [(None,)], "x double"), "x", 10).collect()
    assert [(x.bin, x.bin_lo, x.n) for x in r] == [(5, 3.0, 4)]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (3.0, 3.0), (4.0, 5.0)], "y double, p double")
    r = A.regression_metrics(df, "y", "p").first()
    e = np.array([-0.5, 1.0, 0.0, -1.0])
    assert abs(r.mae - np.abs(e).mean()) < 1e-12
    assert abs(r.rmse - np.sqrt((e ** 2).mean())) < 1e-12
    assert abs(r.r2 - (1 - (e ** 2).sum() / ((np.array([1, 2, 3, 4]) - 2.5) ** 2).sum())) < 1e-12


def test_validation(spark):
    assert missing_columns(empty_frame(spark)) == []
    ok, msg = validate_upload(empty_frame(spark))
    assert not ok and msg.startswith("fewer than")
    df = spark.createDataFrame([(1,)], "Store int")
    ok, msg = validate_upload(df)
    assert not ok and msg.startswith("columns not found: Dept, Date")


def test_long_series_are_cut_into_parts_of_time(spark):
    """Gaps, sparse stretches and null keys: the same features as over whole series."""
    rng = np.random.default_rng(14)
    rows = []
    for store, dept, n in ((1, 1, 400), (1, None, 150), (2, 1, 30), (3, 7, 900)):
        days = np.cumsum(rng.choice([7, 7, 7, 14, 70, 700], n, p=[.5, .2, .1, .1, .07, .03])) if store != 3 else 7 * np.arange(n)
        rows += [(store, dept, int(d), float(rng.normal(100, 30))) for d in days]
    df = spark.createDataFrame(rows, "Store int, Dept int, d int, Weekly_Sales double")
    df = df.withColumn("Date", F.date_add(F.lit("1970-01-05").cast("date"), F.col("d"))).cache()
    key = ["Store", "Dept", "d"]
    want = lag_features(df, series_rows=None).toPandas().sort_values(key).reset_index(drop=True)
    for limit in (3, 40, 200):
        got = lag_features(df, series_rows=limit)
        assert got.columns == list(want.columns)
        got = got.toPandas().sort_values(key).reset_index(drop=True)
        assert got[key].equals(want[key])
        for c in want.columns[-8:]:
            assert np.allclose(got[c], want[c], equal_nan=True), (limit, c)
    parts = F_._parted(df, ["Store", "Dept"], "Date", 40, 12)
    assert parts.where("not _halo").count() == df.count()
    assert parts.where("not _halo").groupBy("Store", "Dept", "_part").count().agg(F.max("count")).first()[0] < 100
