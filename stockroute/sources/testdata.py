"""Role views over the driver's TPC-H-like tables.

The planning data model (weekly sales panel, store dimension, external
factors, retail orders, routing stops and depots) is derived from the given
tables with plain joins and aggregates, so every view grows with the data:

* history panel: lineitem x supplier x part -> (Store = supplier nation,
  Dept = part type code, Date = ISO week start of ship date,
  Weekly_Sales = net revenue)
* stores: nation + supplier counts
* external factors: orders x customer per (customer nation, week)
* retail orders: orders x lineitem x customer x nation x region
* routing stops: suppliers per ship year (plan) with that year's revenue;
  depots: regions; coordinates from the md5 rule of C17.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroute.functions.columns import HOLIDAY_WEEKS, code_map, hash_coordinates

# --- fixed values: test-data role mappings --------------------------------------
PART_TYPE_DEPT = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5,
                  "STANDARD": 6}
REGION_STORE_TYPE = {0: "A", 1: "B", 2: "C", 3: "D", 4: "D"}
PRIORITY_SHIP_MODE = {"1-URGENT": "Same Day", "2-HIGH": "First Class",
                      "3-MEDIUM": "Second Class", "4-NOT SPECIFIED": "Standard Class",
                      "5-LOW": "Freight"}
RETURN_FLAG_TEXT = {"R": " Yes ", "A": "no"}           # 'N' stays null
SUPPLIERS_PER_SIZE_UNIT = 1000
# ---------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def week_start(ts) -> F.Column:
    """Monday of the ISO week of a timestamp, as a date."""
    return F.to_date(F.date_trunc("week", ts))


def holiday_flag(date_col) -> F.Column:
    return F.weekofyear(date_col).isin(list(HOLIDAY_WEEKS))


def sales_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sales per (Store, Dept): the train table of the planning model."""
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_extendedprice",
               "l_discount", "l_shipdate")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part", "p_partkey", "p_type")
    joined = (li.join(sup, li.l_suppkey == sup.s_suppkey)
                .join(part, li.l_partkey == part.p_partkey))
    panel = (joined.groupBy(
                F.col("s_nationkey").cast("int").alias("Store"),
                code_map(F.col("p_type"), PART_TYPE_DEPT, 0).cast("int").alias("Dept"),
                week_start(F.col("l_shipdate")).alias("Date"))
             .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Weekly_Sales")))
    return panel.withColumn("IsHoliday", holiday_flag(F.col("Date")))


def stores_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension: Type from the region, Size from the supplier count."""
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    counts = (table(spark, sf_dir, "supplier", "s_nationkey")
              .groupBy("s_nationkey").agg(F.count("*").alias("n_sup")))
    return (nation.join(counts, nation.n_nationkey == counts.s_nationkey, "left")
            .select(F.col("n_nationkey").cast("int").alias("Store"),
                    code_map(F.col("n_regionkey"), REGION_STORE_TYPE).alias("Type"),
                    (F.coalesce(F.col("n_sup"), F.lit(0)) * SUPPLIERS_PER_SIZE_UNIT)
                    .cast("int").alias("Size")))


def features_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External factors per (Store, Date, IsHoliday) from orders and customers."""
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_totalprice", "o_orderdate",
                   "o_orderpriority", "o_orderstatus")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey)
    md = [F.sum(F.when(F.substring("o_orderpriority", 1, 1) == str(i), F.col("o_totalprice")))
          .alias(f"MarkDown{i}") for i in range(1, 6)]
    agg = (j.groupBy(F.col("c_nationkey").cast("int").alias("Store"),
                     week_start(F.col("o_orderdate")).alias("Date"))
           .agg(F.avg("c_acctbal").alias("acct"), F.avg("o_totalprice").alias("price"),
                F.count("*").alias("n"),
                F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("n_f"),
                *md))
    return agg.select(
        "Store", "Date",
        (F.col("acct") / 100.0).alias("Temperature"),
        (F.col("price") / 100000.0).alias("Fuel_Price"),
        *[f"MarkDown{i}" for i in range(1, 6)],
        (F.col("n") + 100.0).alias("CPI"),
        (F.col("n_f") * 10.0 / F.col("n")).alias("Unemployment"),
        holiday_flag(F.col("Date")).alias("IsHoliday"))


def retail_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail order lines in the shape of the supply-chain sheet."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate",
               "l_returnflag", "l_extendedprice")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate",
                   "o_orderpriority")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(cust, orders.o_custkey == cust.c_custkey)
           .join(geo, cust.c_nationkey == geo.n_nationkey))
    return j.select(
        F.format_string("%d-%d", "l_orderkey", "l_linenumber").alias("Order ID"),
        F.to_date("o_orderdate").alias("Order Date"),
        F.to_date("l_shipdate").alias("Ship Date"),
        code_map(F.col("o_orderpriority"), PRIORITY_SHIP_MODE).alias("Ship Mode"),
        code_map(F.col("l_returnflag"), RETURN_FLAG_TEXT).alias("Returned"),
        F.col("n_name").alias("City"), F.col("r_name").alias("State"),
        F.col("l_extendedprice").alias("Sales"))


def routing_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops: one row per (ship year, supplier) with that year's revenue.

    plan_id is the ship year, so each year is an independent routing plan.
    """
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_extendedprice", "l_discount",
               "l_shipdate")
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    dem = (li.groupBy(F.year("l_shipdate").cast("long").alias("plan_id"),
                      F.col("l_suppkey").alias("stop_id"))
           .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("demand")))
    lat, lon = hash_coordinates(F.col("s_name"), F.col("s_nationkey"))
    geo = sup.select(F.col("s_suppkey").alias("stop_id"), F.col("s_name").alias("stop_name"),
                     lat.alias("lat"), lon.alias("lon"))
    return dem.join(geo, "stop_id").select("plan_id", "stop_id", "stop_name", "lat", "lon",
                                            "demand")


def routing_depots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depots: one per region, coordinates from the md5 rule."""
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    lat, lon = hash_coordinates(F.col("r_name"))
    return region.select(F.col("r_regionkey").cast("int").alias("depot_idx"),
                         F.concat(F.col("r_name"), F.lit(" Depot")).alias("depot_name"),
                         lat.alias("depot_lat"), lon.alias("depot_lon"))
