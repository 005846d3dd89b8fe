"""DuckDB-dialect SQL for the test-data role views (used by the oracles).

These are independent re-statements of ``sources.testdata`` in ANSI SQL so
that each Spark query can be checked against a second engine.
"""

from __future__ import annotations

from stockroute.functions.columns import HOLIDAY_WEEKS
from stockroute.sources.schemas import STORE_COORDINATES
from stockroute.sources.testdata import (
    PART_TYPE_DEPT, PRIORITY_SHIP_MODE, REGION_STORE_TYPE, RETURN_FLAG_TEXT,
    SUPPLIERS_PER_SIZE_UNIT)


def _case(expr: str, mapping: dict, default: str = "NULL") -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


HOLI = ", ".join(str(w) for w in HOLIDAY_WEEKS)


def hash_lat(expr: str) -> str:
    return (f"(25.0 + CAST(('0x' || substr(md5({expr}), 1, 8))::BIGINT AS DOUBLE) "
            f"/ 4294967296.0 * 23.0)")


def hash_lon(expr: str) -> str:
    return (f"(-124.0 + CAST(('0x' || substr(md5({expr}), 9, 8))::BIGINT AS DOUBLE) "
            f"/ 4294967296.0 * 53.0)")


PANEL = f"""
panel AS (
  SELECT CAST(s.s_nationkey AS INTEGER) AS Store,
         CAST({_case('p.p_type', PART_TYPE_DEPT, '0')} AS INTEGER) AS Dept,
         CAST(date_trunc('week', l.l_shipdate) AS DATE) AS Date,
         SUM(l.l_extendedprice * (1 - l.l_discount)) AS Weekly_Sales
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
                  JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2, 3),
sales AS (SELECT *, weekofyear(Date) IN ({HOLI}) AS IsHoliday FROM panel)"""

STORES = f"""
stores AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS Store,
         {_case('n.n_regionkey', REGION_STORE_TYPE)} AS Type,
         CAST(coalesce(c.n_sup, 0) * {SUPPLIERS_PER_SIZE_UNIT} AS INTEGER) AS Size
  FROM nation n LEFT JOIN (SELECT s_nationkey, count(*) AS n_sup FROM supplier GROUP BY 1) c
       ON n.n_nationkey = c.s_nationkey)"""

FEATS = f"""
feats AS (
  SELECT Store, Date, acct / 100.0 AS Temperature, price / 100000.0 AS Fuel_Price,
         MarkDown1, MarkDown2, MarkDown3, MarkDown4, MarkDown5,
         n + 100.0 AS CPI, n_f * 10.0 / n AS Unemployment,
         weekofyear(Date) IN ({HOLI}) AS IsHoliday
  FROM (
    SELECT CAST(c.c_nationkey AS INTEGER) AS Store,
           CAST(date_trunc('week', o.o_orderdate) AS DATE) AS Date,
           avg(c.c_acctbal) AS acct, avg(o.o_totalprice) AS price, count(*) AS n,
           sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_f,
           {", ".join(f"sum(CASE WHEN substr(o.o_orderpriority, 1, 1) = '{i}' THEN o.o_totalprice END) AS MarkDown{i}" for i in range(1, 6))}
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    GROUP BY 1, 2) t)"""

COORDS = "coords(Store, Latitude, Longitude) AS (VALUES " + ", ".join(
    f"({k}, CAST({v[0]} AS DOUBLE), CAST({v[1]} AS DOUBLE))" for k, v in sorted(STORE_COORDINATES.items())) + ")"

MERGED = f"""
merged0 AS (
  SELECT s.Store, s.Dept, s.Date, s.Weekly_Sales, s.IsHoliday, st.Type, st.Size,
         f.Temperature, f.Fuel_Price,
         coalesce(f.MarkDown1, 0.0) AS MarkDown1, coalesce(f.MarkDown2, 0.0) AS MarkDown2,
         coalesce(f.MarkDown3, 0.0) AS MarkDown3, coalesce(f.MarkDown4, 0.0) AS MarkDown4,
         coalesce(f.MarkDown5, 0.0) AS MarkDown5, f.CPI, f.Unemployment
  FROM sales s LEFT JOIN stores st ON s.Store = st.Store
       LEFT JOIN feats f ON s.Store = f.Store AND s.Date = f.Date AND s.IsHoliday = f.IsHoliday),
meds AS (SELECT median(Temperature) AS mt, median(Fuel_Price) AS mf, median(CPI) AS mc,
                median(Unemployment) AS mu FROM merged0),
history AS (
  SELECT m.Store, m.Dept, m.Date, m.Weekly_Sales, CAST(m.IsHoliday AS INTEGER) AS IsHoliday,
         m.Type, m.Size, coalesce(m.Temperature, meds.mt) AS Temperature,
         coalesce(m.Fuel_Price, meds.mf) AS Fuel_Price,
         m.MarkDown1, m.MarkDown2, m.MarkDown3, m.MarkDown4, m.MarkDown5,
         coalesce(m.CPI, meds.mc) AS CPI, coalesce(m.Unemployment, meds.mu) AS Unemployment,
         CAST(year(m.Date) AS INTEGER) AS Year, CAST(month(m.Date) AS INTEGER) AS Month,
         CAST(weekofyear(m.Date) AS INTEGER) AS Week,
         CAST(dayofyear(m.Date) AS INTEGER) AS DayOfYear,
         CAST(quarter(m.Date) AS INTEGER) AS Quarter,
         coalesce(c.Latitude, 39.8) AS Latitude, coalesce(c.Longitude, -98.5) AS Longitude,
         CAST(CASE m.Type WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS INTEGER)
           AS Type_encoded
  FROM merged0 m CROSS JOIN meds LEFT JOIN coords c ON m.Store = c.Store)"""

LAGS = """
lagged AS (
  SELECT *,
    lag(Weekly_Sales, 1) OVER w AS Sales_Lag_1, lag(Weekly_Sales, 2) OVER w AS Sales_Lag_2,
    lag(Weekly_Sales, 4) OVER w AS Sales_Lag_4, lag(Weekly_Sales, 8) OVER w AS Sales_Lag_8,
    lag(Weekly_Sales, 12) OVER w AS Sales_Lag_12,
    avg(Weekly_Sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS Sales_RollingMean_4,
    avg(Weekly_Sales) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS Sales_RollingMean_12,
    coalesce(stddev_samp(Weekly_Sales) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0.0)
      AS Sales_RollingStd_4
  FROM history
  WINDOW w AS (PARTITION BY Store, Dept ORDER BY Date))"""


def with_views(*names: str) -> str:
    """WITH clause holding the requested role views (and what they need)."""
    order = ["panel", "stores", "feats", "coords", "merged", "lags"]
    parts = {"panel": PANEL, "stores": STORES, "feats": FEATS, "coords": COORDS,
             "merged": MERGED, "lags": LAGS}
    need = set(names)
    if "lags" in need:
        need.add("merged")
    if "merged" in need:
        need.update({"panel", "stores", "feats", "coords"})
    return "WITH " + ",\n".join(parts[n].strip() for n in order if n in need)


SHIP_MODE_CASE = _case('"Ship Mode"', {"Same Day": 0, "First Class": 1, "Second Class": 2,
                                        "Standard Class": 3}, "3")
PRIORITY_CASE = _case("o.o_orderpriority", PRIORITY_SHIP_MODE)
RETURN_CASE = _case("l.l_returnflag", RETURN_FLAG_TEXT)


ROUTING = f"""
stops AS (
  SELECT d.plan_id, d.stop_id, s.s_name AS stop_name,
         {hash_lat("s.s_name || '_' || CAST(s.s_nationkey AS VARCHAR)")} AS lat,
         {hash_lon("s.s_name || '_' || CAST(s.s_nationkey AS VARCHAR)")} AS lon, d.demand
  FROM (SELECT CAST(year(l_shipdate) AS BIGINT) AS plan_id, l_suppkey AS stop_id,
               sum(l_extendedprice * (1 - l_discount)) AS demand
        FROM lineitem GROUP BY 1, 2) d
  JOIN supplier s ON d.stop_id = s.s_suppkey),
depots AS (
  SELECT CAST(r_regionkey AS INTEGER) AS depot_idx, r_name || ' Depot' AS depot_name,
         {hash_lat("r_name")} AS depot_lat, {hash_lon("r_name")} AS depot_lon
  FROM region),
sdist AS (
  SELECT s.*, d.depot_idx AS k,
         2 * 6371.0 * asin(sqrt(pow(sin(radians(d.depot_lat - s.lat) / 2), 2)
           + cos(radians(s.lat)) * cos(radians(d.depot_lat))
             * pow(sin(radians(d.depot_lon - s.lon) / 2), 2))) AS km
  FROM stops s CROSS JOIN depots d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY plan_id, stop_id ORDER BY km, k) AS rk FROM sdist)"""


RETAIL = f"""
retail AS (
  SELECT printf('%d-%d', l.l_orderkey, l.l_linenumber) AS "Order ID",
         CAST(o.o_orderdate AS DATE) AS "Order Date", CAST(l.l_shipdate AS DATE) AS "Ship Date",
         {PRIORITY_CASE} AS "Ship Mode", {RETURN_CASE} AS "Returned",
         n.n_name AS City, r.r_name AS State, l.l_extendedprice AS Sales
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey),
retail_clean AS (
  SELECT *, CAST(datediff('day', "Order Date", "Ship Date") AS INTEGER) AS Lead_Time_Days,
         CAST(CASE WHEN lower(trim(coalesce("Returned", 'No'))) = 'yes' THEN 1 ELSE 0 END AS INTEGER)
           AS Returned_flag,
         CAST({SHIP_MODE_CASE} AS INTEGER) AS Ship_Mode_encoded,
         {hash_lat("coalesce(City, '') || '_' || coalesce(State, '')")} AS Latitude,
         {hash_lon("coalesce(City, '') || '_' || coalesce(State, '')")} AS Longitude
  FROM retail)"""


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2 * 6371.0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2}))"
            f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


# Nearest-neighbour tours replayed by a recursive CTE: each step appends, per
# (plan, depot), the nearest unvisited stop that still fits (ties -> lowest
# stop id).  One vehicle per depot, the configuration of the registered
# queries (5 vehicles over 5 depots).
TOURS = f"""
assigned AS (SELECT r.plan_id, r.stop_id, r.stop_name, r.lat, r.lon, r.demand, r.k AS depot_idx
             FROM ranked r WHERE r.rk = 1),
grp AS (SELECT DISTINCT a.plan_id, a.depot_idx, d.depot_name, d.depot_lat, d.depot_lon
        FROM assigned a JOIN depots d ON a.depot_idx = d.depot_idx),
tour(plan_id, depot_idx, step, lat, lon, load, visited, stop_id, stop_name, demand, km, cum) AS (
  SELECT plan_id, depot_idx, 0, depot_lat, depot_lon, CAST(0 AS DOUBLE), CAST([] AS BIGINT[]),
         CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE),
         CAST(0 AS DOUBLE) FROM grp
  UNION ALL
  SELECT plan_id, depot_idx, step, lat, lon, load, visited, stop_id, stop_name, demand, km, cum FROM (
    SELECT t.plan_id, t.depot_idx, t.step + 1 AS step, a.lat, a.lon, t.load + a.demand AS load,
           list_append(t.visited, a.stop_id) AS visited, a.stop_id, a.stop_name, a.demand,
           {_hav('t.lat', 't.lon', 'a.lat', 'a.lon')} AS km,
           t.cum + {_hav('t.lat', 't.lon', 'a.lat', 'a.lon')} AS cum,
           row_number() OVER (PARTITION BY t.plan_id, t.depot_idx
                              ORDER BY {_hav('t.lat', 't.lon', 'a.lat', 'a.lon')}, a.stop_id) AS rn
    FROM tour t JOIN assigned a ON a.plan_id = t.plan_id AND a.depot_idx = t.depot_idx
    WHERE NOT list_contains(t.visited, a.stop_id) AND t.load + a.demand <= 50000000.0) x
  WHERE rn = 1),
served AS (SELECT * FROM tour WHERE step > 0),
lastp AS (SELECT plan_id, depot_idx, max(step) AS ms, arg_max(lat, step) AS llat,
                 arg_max(lon, step) AS llon, arg_max(load, step) AS lload, arg_max(cum, step) AS lcum
          FROM served GROUP BY 1, 2),
route_rows AS (
  SELECT g.plan_id, g.depot_idx, printf('V%d_1', g.depot_idx + 1) AS Vehicle, 0 AS Stop_Order,
         CAST(-1 AS BIGINT) AS stop_id, g.depot_name AS Location, g.depot_lat AS Lat,
         g.depot_lon AS Lon, 0.0 AS Demand, 0.0 AS Cumulative_Load, 0.0 AS Distance_km,
         0.0 AS Cumulative_Distance_km, true AS Is_Depot
  FROM grp g JOIN lastp l ON g.plan_id = l.plan_id AND g.depot_idx = l.depot_idx
  UNION ALL
  SELECT plan_id, depot_idx, printf('V%d_1', depot_idx + 1), step, stop_id, stop_name, lat, lon,
         demand, load, km, cum, false FROM served
  UNION ALL
  SELECT l.plan_id, l.depot_idx, printf('V%d_1', l.depot_idx + 1), l.ms + 1, CAST(-1 AS BIGINT),
         g.depot_name || ' (return)', g.depot_lat, g.depot_lon, 0.0, l.lload,
         {_hav('l.llat', 'l.llon', 'g.depot_lat', 'g.depot_lon')},
         l.lcum + {_hav('l.llat', 'l.llon', 'g.depot_lat', 'g.depot_lon')}, true
  FROM lastp l JOIN grp g ON g.plan_id = l.plan_id AND g.depot_idx = l.depot_idx)"""
