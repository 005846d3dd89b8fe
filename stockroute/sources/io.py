"""Readers and writers.

Readers always take an explicit schema so no inference pass is run over the
data; writers overwrite a folder of part files written by the executors, so
nothing is funnelled through the driver.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroute.sources import schemas as S


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A1/A2/A3: CSV with header and a fixed schema; dates parsed by format.

    Carriage-return line ends (as in the shipped stores file) are accepted.
    """
    return (spark.read.schema(schema)
            .option("header", True)
            .option("dateFormat", date_format)
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """Parquet or CSV table chosen by suffix (Parquet keeps its schema)."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """Missing source -> empty frame with the schema."""
    try:
        df = (spark.read.schema(schema).parquet(path) if fmt == "parquet"
              else read_csv(spark, path, schema))
        df.schema  # resolves the path
        return df
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      multi_line: bool = False) -> DataFrame:
    """A4: stored metrics / scenario records: JSON lines, or with ``multi_line``
    files that hold one document each."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Overwrite a table folder; CSV gets a header and no index."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json_records(df: DataFrame, path: str) -> None:
    """Metric records as JSON lines."""
    df.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence of what ``fit_model`` returns."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A saved pipeline; ``model_features`` tells its inputs in order."""
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    """The feature order a fitted pipeline was trained with."""
    return list(model.stages[0].getInputCols())


@dataclass
class StoredResults:
    """The saved outputs of one planning run, read lazily."""
    predictions: DataFrame
    inventory_plan: DataFrame
    routes: DataFrame
    scenarios: DataFrame
    metrics: DataFrame
    validation: DataFrame
    feature_importance: DataFrame
    naive_cost: DataFrame
    naive_distance: DataFrame
    history: DataFrame | None = None
    model: PipelineModel | None = None


MANIFEST_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("run", T.StringType()),
    T.StructField("tables", T.MapType(T.StringType(), T.LongType()))])


def saved_runs(spark: SparkSession, root: str) -> DataFrame:
    """The whole runs saved below ``root``: seq (rising), run, and rows by table."""
    return read_optional(spark, f"{root}/manifest", MANIFEST_SCHEMA)


def save_results(results, root: str, keep: int | None = None) -> str:
    """Save the tables of a planning run, and its model, as one run.

    Tables go to a folder of their own; one manifest row, written last, makes the run
    known.  A writer that breaks off in between leaves the runs before it as they
    were, and readers never meet tables of two runs.  With ``keep`` the folders of all
    but that many latest runs are removed.  Returns the run's name.
    """
    spark = results.predictions.sparkSession
    run = uuid.uuid4().hex
    folder, rows = f"{root}/runs/{run}", {}
    for name, schema in [*S.RESULT_TABLES.items(), ("history", None)]:
        df = getattr(results, name, None)
        if df is not None:
            if schema is not None:
                df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
            write_table(df, f"{folder}/{name}")
            rows[name] = spark.read.parquet(f"{folder}/{name}").count()     # from the file footers
    if getattr(results, "model", None) is not None:
        save_model(results.model, f"{folder}/model")
    last = saved_runs(spark, root).agg(F.max("seq")).first()[0] or 0
    spark.createDataFrame([(last + 1, run, rows)], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{root}/manifest")
    if keep is not None:
        old = saved_runs(spark, root).orderBy(F.desc("seq"), "run").offset(keep).collect()
        for r in old:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/runs/{r['run']}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return run


def load_results(spark: SparkSession, root: str, with_model: bool = False, run: str | None = None) -> StoredResults:
    """The latest run saved by ``save_results``, or the named one; absent tables are
    empty.  A table with other rows than its manifest tells is an error."""
    known = saved_runs(spark, root)
    found = (known if run is None else known.where(F.col("run") == run)).orderBy(F.desc("seq"), "run").first()
    if found is None and run is not None:
        raise ValueError(f"no run {run} below {root}")
    folder, rows = (f"{root}/runs/{found['run']}", found["tables"]) if found else (root, {})
    tables = {name: read_optional(spark, f"{folder}/{name}", schema) for name, schema in S.RESULT_TABLES.items()}
    try:
        history = spark.read.parquet(f"{folder}/history")
    except AnalysisException:
        history = None
    for name, n in rows.items():
        df = history if name == "history" else tables.get(name)
        if df is None or df.count() != n:
            raise ValueError(f"table {name} of run {found['run']} is not whole")
    return StoredResults(**tables, history=history,
                         model=load_model(f"{folder}/model") if with_model else None)


def to_json_text(df: DataFrame) -> DataFrame:
    """One JSON text column per row (for export without a driver hop)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
