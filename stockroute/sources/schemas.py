"""Explicit schemas (no inference), empty templates and constant dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SALES_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Dept", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Weekly_Sales", T.DoubleType()),
    T.StructField("IsHoliday", T.BooleanType()),
])

SCORING_SCHEMA = T.StructType([f for f in SALES_SCHEMA.fields if f.name != "Weekly_Sales"])

STORES_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Size", T.IntegerType()),
])

FEATURES_SCHEMA = T.StructType(
    [T.StructField("Store", T.IntegerType()),
     T.StructField("Date", T.DateType()),
     T.StructField("Temperature", T.DoubleType()),
     T.StructField("Fuel_Price", T.DoubleType())]
    + [T.StructField(f"MarkDown{i}", T.DoubleType()) for i in range(1, 6)]
    + [T.StructField("CPI", T.DoubleType()),
       T.StructField("Unemployment", T.DoubleType()),
       T.StructField("IsHoliday", T.BooleanType())]
)

# single-table upload contract: 11 required columns (MarkDown1..5 optional)
UPLOAD_REQUIRED = (
    ("Store", T.IntegerType()), ("Dept", T.IntegerType()), ("Date", T.DateType()),
    ("Weekly_Sales", T.DoubleType()), ("IsHoliday", T.BooleanType()),
    ("Temperature", T.DoubleType()), ("Fuel_Price", T.DoubleType()),
    ("CPI", T.DoubleType()), ("Unemployment", T.DoubleType()),
    ("Type", T.StringType()), ("Size", T.IntegerType()),
)
UPLOAD_SCHEMA = T.StructType([T.StructField(n, t) for n, t in UPLOAD_REQUIRED])

RETAIL_SCHEMA = T.StructType([
    T.StructField("Order ID", T.StringType()),
    T.StructField("Order Date", T.DateType()),
    T.StructField("Ship Date", T.DateType()),
    T.StructField("Ship Mode", T.StringType()),
    T.StructField("Returned", T.StringType()),
    T.StructField("City", T.StringType()),
    T.StructField("State", T.StringType()),
    T.StructField("Sales", T.DoubleType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Dept", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Predicted_Weekly_Sales", T.DoubleType()),
])

PLAN_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Week", T.IntegerType()),
    T.StructField("Demand", T.DoubleType()),
    T.StructField("Optimal_Order", T.DoubleType()),
    T.StructField("Inventory_Level", T.DoubleType()),
    T.StructField("Holding_Cost", T.DoubleType()),
    T.StructField("Ordering_Cost", T.DoubleType()),
    T.StructField("Total_Cost", T.DoubleType()),
    T.StructField("method", T.StringType()),
    T.StructField("feasible", T.BooleanType()),
])

ROUTE_SCHEMA = T.StructType([
    T.StructField("plan_id", T.LongType()),
    T.StructField("depot_idx", T.IntegerType()),
    T.StructField("Vehicle", T.StringType()),
    T.StructField("Stop_Order", T.IntegerType()),
    T.StructField("stop_id", T.LongType()),
    T.StructField("Location", T.StringType()),
    T.StructField("Lat", T.DoubleType()),
    T.StructField("Lon", T.DoubleType()),
    T.StructField("Demand", T.DoubleType()),
    T.StructField("Cumulative_Load", T.DoubleType()),
    T.StructField("Distance_km", T.DoubleType()),
    T.StructField("Cumulative_Distance_km", T.DoubleType()),
    T.StructField("Is_Depot", T.BooleanType()),
])

DEPOT_SCHEMA = T.StructType([
    T.StructField("depot_idx", T.IntegerType()),
    T.StructField("depot_name", T.StringType()),
    T.StructField("depot_lat", T.DoubleType()),
    T.StructField("depot_lon", T.DoubleType()),
])

STOP_SCHEMA = T.StructType([
    T.StructField("plan_id", T.LongType()),
    T.StructField("stop_id", T.LongType()),
    T.StructField("stop_name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("demand", T.DoubleType()),
])

SCENARIO_SCHEMA = T.StructType([
    T.StructField("scenario", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

METRICS_SCHEMA = T.StructType([
    T.StructField("split", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
])

VALIDATION_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Dept", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Weekly_Sales", T.DoubleType()),
    T.StructField("Predicted_Sales", T.DoubleType()),
])

IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("importance", T.DoubleType()),
])

NAIVE_COST_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("naive_cost", T.DoubleType()),
])

NAIVE_DISTANCE_SCHEMA = T.StructType([
    T.StructField("plan_id", T.LongType()),
    T.StructField("naive_km", T.DoubleType()),
    T.StructField("n_stops", T.LongType()),
])

# the tables of a planning run as they are saved and read again
RESULT_TABLES = {
    "predictions": PREDICTION_SCHEMA, "inventory_plan": PLAN_SCHEMA, "routes": ROUTE_SCHEMA,
    "scenarios": SCENARIO_SCHEMA, "metrics": METRICS_SCHEMA, "validation": VALIDATION_SCHEMA,
    "feature_importance": IMPORTANCE_SCHEMA, "naive_cost": NAIVE_COST_SCHEMA,
    "naive_distance": NAIVE_DISTANCE_SCHEMA,
}

# --- fixed values: coordinates of the 45 sample stores (Store: lat, lon) -------
STORE_COORDINATES = {
    1: (33.4484, -112.0740), 2: (34.0522, -118.2437), 3: (41.8781, -87.6298),
    4: (29.7604, -95.3698), 5: (40.7128, -74.0060), 6: (33.7490, -84.3880),
    7: (39.7392, -104.9903), 8: (47.6062, -122.3321), 9: (25.7617, -80.1918),
    10: (32.7767, -96.7970), 11: (42.3601, -71.0589), 12: (36.1627, -86.7816),
    13: (38.9072, -77.0369), 14: (39.9526, -75.1652), 15: (35.2271, -80.8431),
    16: (30.2672, -97.7431), 17: (37.7749, -122.4194), 18: (44.9778, -93.2650),
    19: (29.9511, -90.0715), 20: (43.0389, -87.9065), 21: (35.1495, -90.0490),
    22: (38.2527, -85.7585), 23: (39.1031, -84.5120), 24: (36.1699, -115.1398),
    25: (32.7157, -117.1611), 26: (45.5152, -122.6784), 27: (41.2565, -95.9345),
    28: (35.4676, -97.5164), 29: (27.9506, -82.4572), 30: (26.1224, -80.1373),
    31: (31.7619, -106.4850), 32: (33.5207, -86.8025), 33: (37.3382, -121.8863),
    34: (40.4406, -79.9959), 35: (41.4993, -81.6944), 36: (34.7465, -92.2896),
    37: (39.7684, -86.1581), 38: (38.6270, -90.1994), 39: (42.3314, -83.0458),
    40: (30.3322, -81.6557), 41: (37.5407, -77.4360), 42: (28.5383, -81.3792),
    43: (35.7796, -78.6382), 44: (36.7468, -119.7726), 45: (32.2226, -110.9747),
}

# --- fixed values: store display names (Store: name) ---------------------------
STORE_NAMES = {
    1: "Phoenix, AZ", 2: "Los Angeles, CA", 3: "Chicago, IL", 4: "Houston, TX",
    5: "New York, NY", 6: "Atlanta, GA", 7: "Denver, CO", 8: "Seattle, WA",
    9: "Miami, FL", 10: "Dallas, TX", 11: "Boston, MA", 12: "Nashville, TN",
    13: "Washington, DC", 14: "Philadelphia, PA", 15: "Charlotte, NC",
    16: "Austin, TX", 17: "San Francisco, CA", 18: "Minneapolis, MN",
    19: "New Orleans, LA", 20: "Milwaukee, WI", 21: "Memphis, TN",
    22: "Louisville, KY", 23: "Cincinnati, OH", 24: "Las Vegas, NV",
    25: "San Diego, CA", 26: "Portland, OR", 27: "Omaha, NE",
    28: "Oklahoma City, OK", 29: "Tampa, FL", 30: "Fort Lauderdale, FL",
    31: "El Paso, TX", 32: "Birmingham, AL", 33: "San Jose, CA",
    34: "Pittsburgh, PA", 35: "Cleveland, OH", 36: "Little Rock, AR",
    37: "Indianapolis, IN", 38: "St. Louis, MO", 39: "Detroit, MI",
    40: "Jacksonville, FL", 41: "Richmond, VA", 42: "Orlando, FL",
    43: "Raleigh, NC", 44: "Fresno, CA", 45: "Tucson, AZ",
}

# --- fixed values: department display names (Dept: name; keys not contiguous) --
DEPT_NAMES = {
    1: "Grocery", 2: "Apparel", 3: "Electronics", 4: "Home & Garden",
    5: "Pharmacy", 6: "Toys & Games", 7: "Automotive", 8: "Sporting Goods",
    9: "Health & Beauty", 10: "Frozen Foods", 11: "Dairy", 12: "Bakery",
    13: "Deli & Prepared", 14: "Beverages", 15: "Snacks & Candy",
    16: "Pet Supplies", 17: "Baby Products", 18: "Office Supplies",
    19: "Seasonal", 20: "Furniture", 21: "Jewelry", 22: "Shoes",
    23: "Stationery", 24: "Hardware", 25: "Garden Center",
    26: "Kitchen & Dining", 27: "Bedding & Bath", 28: "Cleaning Supplies",
    29: "Paper Goods", 30: "Meat & Seafood", 31: "Produce",
    32: "Wine & Spirits", 33: "Men's Clothing", 34: "Women's Clothing",
    35: "Kids' Clothing", 36: "Accessories", 37: "Footwear",
    38: "Home Décor", 39: "Luggage", 40: "Books & Media",
    41: "Craft Supplies", 42: "Party Supplies", 43: "Outdoor Living",
    44: "Small Appliances", 45: "Major Appliances", 46: "Flooring",
    47: "Paint", 48: "Plumbing", 49: "Electrical", 50: "Lighting",
    51: "Storage", 52: "Fabric & Sewing", 53: "Musical Instruments",
    54: "Cameras", 55: "Cell Phones", 56: "Video Games",
    57: "Movies & TV", 58: "Music", 59: "Tobacco", 60: "Optical",
    61: "Wireless", 62: "Photo Center", 63: "Fine Jewelry",
    64: "Watches", 65: "Celebration", 67: "Personal Care",
    71: "Swimwear", 72: "Intimates", 77: "Collectibles",
    78: "Community", 79: "Seasonal Décor", 80: "Impulse Items",
    81: "Floral", 82: "Celebrations", 83: "Uniforms",
    85: "Custom Orders", 87: "Fuel Station", 90: "Services",
    91: "Layaway", 92: "Tire Center", 93: "Auto Services",
    94: "Pharmacy Rx", 95: "Clinic", 96: "Optical Services",
    97: "Financial", 98: "Returns", 99: "General Merch",
}
# -------------------------------------------------------------------------------


def empty_frame(spark: SparkSession, schema: T.StructType = UPLOAD_SCHEMA) -> DataFrame:
    """A10: empty table carrying a required schema (upload template)."""
    return spark.createDataFrame([], schema)


def store_coordinates(spark: SparkSession) -> DataFrame:
    """45-row dimension (Store, Latitude, Longitude)."""
    rows = [(k, v[0], v[1]) for k, v in sorted(STORE_COORDINATES.items())]
    return spark.createDataFrame(rows, "Store int, Latitude double, Longitude double")


def store_names(spark: SparkSession) -> DataFrame:
    """Store display names."""
    return spark.createDataFrame(sorted(STORE_NAMES.items()), "Store int, Store_Name string")


def dept_names(spark: SparkSession) -> DataFrame:
    """Department display names."""
    return spark.createDataFrame(sorted(DEPT_NAMES.items()), "Dept int, Dept_Name string")


def depot_frame(spark: SparkSession, depots=None) -> DataFrame:
    """Depots from parameters (idx, name, lat, lon)."""
    from stockroute.config import DEFAULT_DEPOTS
    rows = [(int(i), str(n), float(la), float(lo)) for i, n, la, lo in (depots or DEFAULT_DEPOTS)]
    return spark.createDataFrame(rows, DEPOT_SCHEMA)


def sample_stops(spark: SparkSession, demands: DataFrame | None = None,
                 default_demand: float | None = None) -> DataFrame:
    """The 45 sample stores as routing stops (one plan, id 0).

    ``demands`` (Store, demand) supplies demand per store; missing stores get
    ``default_demand`` or the seeded default of C30.
    """
    from pyspark.sql import functions as F
    from stockroute.functions.columns import default_demand as seeded
    coords = store_coordinates(spark)
    stops = coords.select(
        F.lit(0).cast("long").alias("plan_id"), F.col("Store").cast("long").alias("stop_id"),
        F.format_string("Store %d", F.col("Store")).alias("stop_name"),
        F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    if demands is not None:
        stops = stops.join(demands.select(F.col("Store").cast("long").alias("stop_id"), "demand"),
                           "stop_id", "left")
    else:
        stops = stops.withColumn("demand", F.lit(None).cast("double"))
    d = (F.coalesce(F.col("demand"), F.lit(float(default_demand))) if default_demand is not None
         else seeded(F.col("demand"), F.col("stop_id")))
    return stops.select("plan_id", "stop_id", "stop_name", "lat", "lon", d.alias("demand"))
