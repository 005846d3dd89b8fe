"""History preparation and lag features (I1-I5 with C1-C19, E1-E3, D3-D4, G1-G4).

A single window specification ``partitionBy(keys).orderBy(Date)`` carries
every lag and rolling statistic, so the panel is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroute.functions.columns import (
    DEFAULT_LATLON, SHIP_MODE_CODES, SHIP_MODE_DEFAULT, TYPE_CODES,
    bool_to_int, calendar_parts, code_map, fill_zero, hash_coordinates, lead_time_days,
    optional_zero, yes_flag)
from stockroute.operators.aggregates import exact_medians
from stockroute.operators.joins import lookup_with_default

SERIES_ROWS = 1_000_000     # rows of a series that one task may order
MARKDOWNS = [f"MarkDown{i}" for i in range(1, 6)]
IMPUTED = ["CPI", "Unemployment", "Temperature", "Fuel_Price"]

# 19 features of the file-based pipeline, 14 of the in-memory one
FEATURES_FULL = ["Store", "Dept", "Type_encoded", "Size", "Temperature", "Fuel_Price", "CPI",
                 "Unemployment", *MARKDOWNS, "IsHoliday", "Year", "Month", "Week",
                 "DayOfYear", "Quarter"]
FEATURES_BASIC = ["Store", "Dept", "Type_encoded", "Size", "Temperature", "Fuel_Price", "CPI",
                  "Unemployment", "IsHoliday", "Year", "Month", "Week", "DayOfYear", "Quarter"]


def lag_names(lags=(1, 2, 4, 8, 12)) -> list[str]:
    return [f"Sales_Lag_{k}" for k in lags] + [
        "Sales_RollingMean_4", "Sales_RollingMean_12", "Sales_RollingStd_4"]


def _nan_to_null(c: str) -> F.Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill nulls with the exact median of the same frame's rows."""
    present = [c for c in cols if c in df.columns]
    med = exact_medians(df, present)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(med[c])) if med[c] is not None
                           else F.col(c) for c in present})


def add_coordinates(df: DataFrame, coords: DataFrame, key: str = "Store") -> DataFrame:
    """Latitude/Longitude by store with the default (39.8, -98.5)."""
    return lookup_with_default(df, coords.select(key, "Latitude", "Longitude"), key,
                               {"Latitude": DEFAULT_LATLON[0], "Longitude": DEFAULT_LATLON[1]})


def join_history(sales: DataFrame, stores: DataFrame, features: DataFrame,
                 coords: DataFrame, type_default: int | None = None) -> DataFrame:
    """I1/I2 without the median fill: sales x stores x features with calendar
    parts, zero-filled markdowns, codes and coordinates (lazy, no job)."""
    merged = sales.join(stores, "Store", "left")
    feats = features.select("Store", "Date", "IsHoliday",
                            *[c for c in features.columns if c not in ("Store", "Date", "IsHoliday")])
    merged = merged.join(feats, ["Store", "Date", "IsHoliday"], "left")
    merged = merged.withColumns({c: _nan_to_null(c) for c in IMPUTED + MARKDOWNS
                                 if c in merged.columns})
    merged = merged.withColumns(calendar_parts(F.col("Date")))
    merged = merged.withColumns({c: fill_zero(c) for c in MARKDOWNS if c in merged.columns})
    merged = add_coordinates(merged, coords)
    return merged.withColumns({
        "IsHoliday": bool_to_int("IsHoliday"),
        "Type_encoded": code_map(F.col("Type"), TYPE_CODES, type_default),
    })


def prepare_history(sales: DataFrame, stores: DataFrame, features: DataFrame,
                    coords: DataFrame, type_default: int | None = None,
                    impute: bool = True) -> DataFrame:
    """Sales x stores x features with calendar parts, fills and codes.

    Works for the train table and the scoring table (no Weekly_Sales).
    Medians are taken over the joined rows, as in the file-based pipeline.
    Callers that materialise the result may persist ``join_history`` first
    so the median passes and the final write share one computation.
    """
    merged = join_history(sales, stores, features, coords, type_default)
    return impute_median(merged, IMPUTED) if impute else merged


def engineer_features(df: DataFrame, coords: DataFrame, type_default: int = 1) -> DataFrame:
    """Single-table upload -> model features (unmapped Type -> 1,
    optional MarkDowns added as 0, medians over the upload)."""
    cols = df.columns
    out = df.withColumn("Date", F.to_date("Date"))
    out = out.withColumns(calendar_parts(F.col("Date")))
    out = out.withColumns({
        "IsHoliday": bool_to_int("IsHoliday"),
        "Type_encoded": code_map(F.col("Type"), TYPE_CODES, type_default),
    })
    out = out.withColumns({c: _nan_to_null(c) for c in IMPUTED if c in cols})
    out = impute_median(out, IMPUTED)
    out = out.withColumns({m: optional_zero(cols, m) for m in MARKDOWNS})
    return add_coordinates(out, coords)


def prepare_orders(df: DataFrame) -> DataFrame:
    """I4: lead time, returned flag, ship-mode code, synthetic coordinates
    (worked out once for each city and state)."""
    places = df.select(F.coalesce("City", F.lit("")).alias("_city"),
                       F.coalesce("State", F.lit("")).alias("_state")).distinct()
    lat, lon = hash_coordinates(F.col("_city"), F.col("_state"))
    places = places.withColumns({"Latitude": lat, "Longitude": lon})
    placed = df.join(places, (F.coalesce(df["City"], F.lit("")) == places["_city"])
                     & (F.coalesce(df["State"], F.lit("")) == places["_state"])).drop("_city", "_state")
    return placed.withColumns({
        "Order Date": F.to_date("Order Date"),
        "Ship Date": F.to_date("Ship Date"),
    }).withColumns({
        "Lead_Time_Days": lead_time_days("Ship Date", "Order Date"),
        "Returned": yes_flag(F.coalesce(F.col("Returned"), F.lit("No"))),
        "Ship_Mode_encoded": code_map(F.col("Ship Mode"), SHIP_MODE_CODES, SHIP_MODE_DEFAULT),
    })


def _same(keys: list[str], left: str, right: str) -> F.Column:
    """Null-safe equality of the keys of two aliased frames."""
    met = F.lit(True)
    for k in keys:
        met = met & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return met


def _parted(df: DataFrame, keys: list[str], order: str, rows: int, halo: int) -> DataFrame:
    """Rows of long series with the parts of time that read them: ``_part`` and ``_halo``
    (true where a part only looks back at the row).

    Stretches of four weeks are counted once; about ``rows`` rows make a part, and the
    stretches that hold the last ``halo`` rows before a later part go to it as well.
    """
    stretch = F.floor(F.datediff(F.col(order), F.lit("1970-01-01").cast("date")) / 28).cast("int")
    df = df.withColumn("_at", stretch)
    upto = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    counted = (df.groupBy(*keys, "_at").agg(F.count("*").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
               .withColumn("_part", F.floor(F.col("_before") / rows)))
    starts = counted.groupBy(*keys, F.col("_part").alias("_to")).agg(F.min("_before").alias("_start"))
    later = (counted.alias("c").join(starts.alias("s"), _same(keys, "c", "s"))
             .where((F.col("_to") > F.col("_part")) & (F.col("_start") - F.col("_before") - F.col("_n") < halo))
             .select(*[f"c.{k}" for k in keys], "_at", F.col("_to").alias("_part"), F.lit(True).alias("_halo")))
    own = counted.select(*keys, "_at", "_part", F.lit(False).alias("_halo"))
    return (df.alias("l").join(own.unionByName(later).alias("r"), _same([*keys, "_at"], "l", "r"))
            .select("l.*", "_part", "_halo").drop("_at"))


def lag_features(df: DataFrame, lags=(1, 2, 4, 8, 12), keys=("Store", "Dept"),
                 order: str = "Date", target: str = "Weekly_Sales",
                 series_rows: int | None = SERIES_ROWS) -> DataFrame:
    """Row lags, trailing means of the previous 4 and 12 rows and the
    trailing sample std of the previous 4 rows (null -> 0), one window.

    Series of more than ``series_rows`` rows are cut into parts of time, each with the
    rows before it that its first ones look back at, so that no task holds a whole long
    series; all others keep the one exchange by series.  (One small count tells which;
    None leaves it out, and every series whole.)
    """
    y, keys = F.col(target), list(keys)

    def featured(rows: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order)
        cols = {f"Sales_Lag_{k}": F.lag(y, k).over(w) for k in lags}
        cols["Sales_RollingMean_4"] = F.avg(y).over(w.rowsBetween(-4, -1))
        cols["Sales_RollingMean_12"] = F.avg(y).over(w.rowsBetween(-12, -1))
        cols["Sales_RollingStd_4"] = F.coalesce(F.stddev_samp(y).over(w.rowsBetween(-4, -1)), F.lit(0.0))
        return rows.withColumns(cols)

    if series_rows is None:
        return featured(df, keys)
    long_ = df.groupBy(*keys).count().where(F.col("count") > series_rows).select(*keys)
    if long_.isEmpty():
        return featured(df, keys)
    rest = df.alias("s").join(long_.alias("h"), _same(keys, "s", "h"), "left_anti")
    hot = df.alias("s").join(long_.alias("h"), _same(keys, "s", "h"), "left_semi")
    parted = _parted(hot, keys, order, series_rows, max(max(lags), 12))
    return featured(rest, keys).unionByName(
        featured(parted, [*keys, "_part"]).where(~F.col("_halo")).drop("_part", "_halo"))


def model_rows(df: DataFrame, lags=(1, 2, 4, 8, 12)) -> DataFrame:
    """D3: drop the warm-up rows whose lag features are null."""
    return df.na.drop(subset=lag_names(lags))


def time_split(df: DataFrame, test_weeks: int = 13, date_col: str = "Date") -> DataFrame:
    """Label rows 'train' (<= max - test_weeks) or 'val'.

    The cutoff is a scalar subquery (one tiny job), not a cross join.
    """
    cutoff = F.date_sub(df.agg(F.max(date_col)).scalar(), 7 * test_weeks)
    return df.withColumn("split", F.when(F.col(date_col) <= cutoff, F.lit("train"))
                         .otherwise(F.lit("val")))
