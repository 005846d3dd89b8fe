"""Forecasting (I6-I13) with Spark ML gradient-boosted trees.

* fit: VectorAssembler + GBTRegressor on the training split (features are
  persisted once, the trees are fitted by Spark's distributed learner);
* evaluation: F16 metrics on train and validation rows;
* forecast: per series the last row (exogenous features frozen) and the tail
  of the sales history as an array column; 13 future weeks are produced by
  ``explode(sequence)`` (frozen lags), or recursively: the fitted trees travel
  as flat arrays (``trees``) and all weeks of a batch of series are evaluated
  in one narrow stage.  A rule instead of a model takes a step a week.
"""

from __future__ import annotations

from datetime import date

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroute.config import ForecastParams
from stockroute.functions.columns import add_weeks, calendar_parts, clamp_zero
from stockroute.operators.aggregates import regression_metrics
from stockroute.operators import trees
from stockroute.operators.features import (
    FEATURES_BASIC, FEATURES_FULL, lag_features, lag_names, model_rows, time_split)
from stockroute.session import shared_table

KEYS = ["Store", "Dept"]
ROWS_PER_FIT_PARTITION = 25_000


def feature_columns(p: ForecastParams = ForecastParams()) -> list[str]:
    """Model inputs in a fixed order (19 or 14 base features + lags)."""
    base = FEATURES_FULL if p.with_markdowns else FEATURES_BASIC
    return list(base) + lag_names(p.lags)


def _assembled(df: DataFrame, cols: list[str]) -> DataFrame:
    # Absent feature -> 0, null feature -> 0 before assembly
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
                           if c in df.columns else F.lit(0.0) for c in cols})


def prepare_model_frame(history: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """I5 -> D3 -> I6: lagged, complete rows labelled train / val."""
    return time_split(model_rows(lag_features(history, p.lags), p.lags), p.test_weeks)


def fit_model(frame: DataFrame, p: ForecastParams = ForecastParams(),
              label: str = "Weekly_Sales", rows: int | None = None) -> PipelineModel:
    """Gradient-boosted regression on the training rows.

    Both parts of a split hold ``min_leaf`` rows, so no node of fewer than twice as many
    is split: that is the rule of ``min_split`` too, which may not ask for more.  With
    ``rows``, an upper bound of the training rows that the caller knows already (from
    ``counted_table``), they need no count of their own.
    """
    if p.min_split > 2 * p.min_leaf:
        raise ValueError(f"min_split {p.min_split} is more than two leaves of {p.min_leaf} rows")
    cols = feature_columns(p)
    train = _assembled(frame.where(F.col("split") == "train"), cols) \
        .select(*cols, F.col(label).alias("label"))
    # dealt evenly, with no more partitions than the rows need (the learner runs a few
    # small jobs per tree level) and no upper bound; evaluated once
    held = None
    if rows is None:
        train = held = train.persist(StorageLevel.MEMORY_AND_DISK)
        rows = train.count()
    parts = max(1, -(-rows // ROWS_PER_FIT_PARTITION))
    gbt = GBTRegressor(featuresCol="features", labelCol="label", predictionCol="prediction",
                       maxIter=p.n_estimators, maxDepth=p.max_depth, stepSize=p.learning_rate,
                       subsamplingRate=p.subsample, minInstancesPerNode=p.min_leaf, seed=p.seed,
                       maxBins=32)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features",
                                            handleInvalid="keep"), gbt])
    try:
        return pipe.fit(train.repartition(parts))
    finally:
        if held is not None:
            held.unpersist()


def score(model: PipelineModel | Column, df: DataFrame, p: ForecastParams = ForecastParams(),
          out: str = "prediction") -> DataFrame:
    """I8: batch scoring; input columns are kept (E9 pairing without a join).

    ``model`` is a fitted pipeline, or a Column over the features: a rule such
    as a moving average, for which every later step is the same.
    """
    cols = feature_columns(p)
    keep = [c for c in df.columns if c not in cols]
    ready = _assembled(df, cols)
    if isinstance(model, Column):
        return ready.select(*keep, *cols, model.cast("double").alias(out))
    scored = model.transform(ready).drop("features")
    return scored.withColumnRenamed("prediction", out).select(*keep, *cols, out)


def evaluate(model: PipelineModel | Column, frame: DataFrame, p: ForecastParams = ForecastParams(),
             label: str = "Weekly_Sales") -> tuple[DataFrame, DataFrame]:
    """(metrics per split, validation predictions); rows are scored once."""
    # the columns by name: Store and Dept are features too, and then doubles
    scored = shared_table(score(model, frame, p).select(
        *[F.col(c).cast("int") for c in KEYS], "Date", label, "prediction", "split"), "scored")
    metrics = regression_metrics(scored, label, "prediction", by=["split"])
    validation = scored.where(F.col("split") == "val").select(
        *KEYS, "Date", label, F.col("prediction").alias("Predicted_Sales"))
    return metrics, validation


def feature_importance(model: PipelineModel | Column, p: ForecastParams = ForecastParams()) -> DataFrame:
    """(feature, importance) rows from the fitted trees; none for a rule."""
    from pyspark.sql import SparkSession
    if isinstance(model, Column):
        return SparkSession.getActiveSession().createDataFrame([], "feature string, importance double")
    imp = model.stages[-1].featureImportances.toArray().tolist()
    session = SparkSession.getActiveSession()
    return session.createDataFrame(list(zip(feature_columns(p), [float(x) for x in imp])),
                                   "feature string, importance double")


def top_features(imp: DataFrame, k: int = 12) -> DataFrame:
    """H3: top-k features by importance."""
    return imp.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


# ---------------------------------------------------------------- forecasting state
def series_state(history: DataFrame, p: ForecastParams = ForecastParams(),
                 label: str = "Weekly_Sales") -> DataFrame:
    """F14/G7/G8 input: per eligible series the frozen last row, the sales
    tail (last ``max(lags, 12)`` values), the first value and the length."""
    tail = max(max(p.lags), 12)
    exo = [c for c in feature_columns(p) if c not in lag_names(p.lags)]
    exo = [c for c in exo if c in history.columns]
    # one shuffle: the window partitions by series, the aggregate reuses it;
    # only the last ``tail`` rows of a series are collected
    w_desc = Window.partitionBy(*KEYS).orderBy(F.col("Date").desc())
    w_all = w_desc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = history.select(*KEYS, "Date", label, *[c for c in exo if c not in KEYS]).withColumns({
        "_rk": F.row_number().over(w_desc),
        "_n": F.count(F.lit(1)).over(w_all),
        "_first": F.last(F.col(label)).over(w_all)})
    agg = ranked.where(F.col("_rk") <= tail).groupBy(*KEYS).agg(
        F.max_by(F.struct(*[c for c in exo if c not in KEYS]), "Date").alias("last"),
        F.first("_n").alias("n"), F.first("_first").alias("first"),
        F.transform(F.sort_array(F.collect_list(F.struct("Date", label))),
                    lambda x: x[label]).alias("_t"))
    return (agg.where(F.col("n") >= p.min_history)
            .withColumnRenamed("_t", "recent").select(*KEYS, "last.*", "n", "first", "recent"))


def _lag_from_tail(recent: Column, n: Column, first: Column, lag: int) -> Column:
    """K-th last value, or the first value when the series is shorter."""
    return F.when(n - lag >= 0, F.try_element_at(recent, F.lit(-lag))).otherwise(first)


def _last(arr: Column, k: int) -> Column:
    """Last ``k`` elements (all of them when the array is shorter), like x[-k:]."""
    return F.slice(arr, -F.least(F.size(arr), F.lit(k)), k)


def _tail_mean(recent: Column, k: int) -> Column:
    s = _last(recent, k)
    return F.aggregate(s, F.lit(0.0), lambda a, x: a + x) / F.size(s)


def _tail_std(recent: Column, n: Column, k: int, population: bool) -> Column:
    s = _last(recent, k)
    m = F.aggregate(s, F.lit(0.0), lambda a, x: a + x) / F.size(s)
    ss = F.aggregate(s, F.lit(0.0), lambda a, x: a + (x - m) * (x - m))
    denom = F.size(s) if population else F.size(s) - 1
    return F.when(n >= k, F.sqrt(ss / denom)).otherwise(F.lit(0.0))


def _step_features(df: DataFrame, p: ForecastParams) -> DataFrame:
    rec, n, first = F.col("recent"), F.col("n"), F.col("first")
    cols = {f"Sales_Lag_{k}": _lag_from_tail(rec, n, first, k) for k in p.lags}
    cols["Sales_RollingMean_4"] = _tail_mean(rec, 4)
    cols["Sales_RollingMean_12"] = _tail_mean(rec, 12)
    cols["Sales_RollingStd_4"] = _tail_std(rec, n, 4, p.serve_std_population)
    return df.withColumns(cols)


def _future_calendar(df: DataFrame, last_date: Column, w: Column) -> DataFrame:
    d = add_weeks(last_date, w)
    return df.withColumn("Date", d).withColumns(calendar_parts(F.col("Date")))


def forecast_direct(model: PipelineModel | Column, history: DataFrame,
                    p: ForecastParams = ForecastParams()) -> DataFrame:
    """13 weeks per series with the lag features frozen at the last
    observation (the file-based pipeline's behaviour)."""
    last_date = history.agg(F.max("Date")).scalar()
    st = _step_features(series_state(history, p), p)
    rows = st.withColumn("w", F.explode(F.sequence(F.lit(1), F.lit(p.horizon))))
    rows = rows.withColumn("_last", last_date)
    rows = _future_calendar(rows, F.col("_last"), F.col("w")).drop("_last")
    scored = score(model, rows, p)
    return scored.select(*[F.col(c).cast("int") for c in KEYS], "Date",
                         F.bround(clamp_zero("prediction"), 2).alias("Predicted_Weekly_Sales"))


def forecast_recursive(model: PipelineModel | Column, history: DataFrame,
                       p: ForecastParams = ForecastParams(), last: date | None = None) -> DataFrame:
    """Each prediction (clamped at 0) joins the series' tail, so that later lags
    and rolling features see it.

    A fitted model is read once as flat arrays; one narrow stage of Arrow batches then
    walks all weeks of every series, with nothing written and nothing shuffled between
    weeks.  A rule is a Column, so it takes a step a week (``forecast_by_steps``).
    ``last`` is the history's last date, where the caller knows it.
    """
    if isinstance(model, Column):
        return forecast_by_steps(model, history, p)
    last = last or history.agg(F.max("Date")).first()[0]
    spark = history.sparkSession
    weeks = _future_calendar(spark.range(1, p.horizon + 1).withColumn("w", F.col("id").cast("int")),
                             F.lit(last), F.col("w")).orderBy("w").collect() if last else []
    calendar = [{c: w[c] for c in w.__fields__ if c not in ("id", "w", "Date")} for w in weeks]
    dates = [w["Date"] for w in weeks]
    cols = feature_columns(p)
    state = series_state(history, p)
    ready = state.select(
        *[F.col(c).cast("int").alias(f"_{c}") for c in KEYS], "n", F.col("first").cast("double").alias("first"),
        F.col("recent").cast("array<double>").alias("recent"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols if c in state.columns])
    run = trees.recursive_weeks(trees.flat(model.stages[-1]), cols, p.lags, calendar, dates,
                                max(max(p.lags), 12), p.serve_std_population)
    out = ready.mapInArrow(run, "Store int, Dept int, Date date, p double")
    return out.select(*KEYS, "Date", F.bround("p", 2).alias("Predicted_Weekly_Sales"))


def forecast_by_steps(model: PipelineModel | Column, history: DataFrame,
                      p: ForecastParams = ForecastParams()) -> DataFrame:
    """I12 week by week, for any predictor: the state of all series is written to the
    shared folder after each step, so a step's expression is not nested into the next."""
    tail = max(max(p.lags), 12)
    last_date = history.agg(F.max("Date")).scalar()
    state = series_state(history, p).withColumn("_last", last_date) \
        .withColumn("preds", F.array().cast("array<double>"))
    base_cols = state.columns
    for w in range(1, p.horizon + 1):
        step = _future_calendar(_step_features(state, p), F.col("_last"), F.lit(w))
        scored = score(model, step, p, out="_p")
        pred = clamp_zero("_p")
        state = scored.select(
            *[c for c in base_cols if c not in ("recent", "n", "preds")],
            _last(F.concat(F.col("recent"), F.array(pred)), tail).alias("recent"),
            (F.col("n") + 1).alias("n"),
            F.concat(F.col("preds"), F.array(pred)).alias("preds"))
        state = state.select(*base_cols)
        if w < p.horizon:
            state = shared_table(state, "forecast-state")
    out = state.select(*KEYS, "_last", F.posexplode("preds").alias("i", "p"))
    return out.select(*[F.col(c).cast("int") for c in KEYS],
                      add_weeks(F.col("_last"), F.col("i") + 1).alias("Date"),
                      F.bround("p", 2).alias("Predicted_Weekly_Sales"))


def history_and_forecast(history: DataFrame, predictions: DataFrame,
                         label: str = "Weekly_Sales") -> DataFrame:
    """H8: history and forecast on one axis with a ``kind`` column."""
    h = history.select(*KEYS, "Date", F.col(label).alias("value"), F.lit("history").alias("kind"))
    f = predictions.select(*KEYS, "Date", F.col("Predicted_Weekly_Sales").alias("value"),
                           F.lit("forecast").alias("kind"))
    return h.unionByName(f)


def forecast_stage(history: DataFrame, p: ForecastParams = ForecastParams(),
                   recursive: bool = False, predictor: Column | None = None, seen: dict | None = None):
    """(model, metrics, validation, predictions, importances) for one history;
    with ``predictor`` that rule stands in for the fitted model.  ``seen`` holds the
    history's ``rows`` and ``last`` date where its write has observed them."""
    seen = seen or {}
    frame = prepare_model_frame(history, p)
    model = fit_model(frame, p, rows=seen.get("rows")) if predictor is None else predictor
    metrics, validation = evaluate(model, frame, p)
    preds = (forecast_recursive(model, history, p, seen.get("last")) if recursive
             else forecast_direct(model, history, p))
    return model, metrics, validation, preds, feature_importance(model, p)
