"""Scalar column expressions.

Every function here returns a ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage code generation.  IDs in the docstrings refer
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "EARTH_RADIUS_KM", "DEFAULT_LATLON", "TYPE_CODES", "SHIP_MODE_CODES",
    "HOLIDAY_WEEKS", "calendar_parts",
    "add_weeks", "date_text", "lead_time_days", "fill_zero", "optional_zero",
    "bool_to_int", "code_map", "yes_flag", "hash_coordinates", "clamp_zero",
    "round2", "ceil_floor_zero", "haversine_km", "scale_when", "guarded_ratio",
    "pct_change", "fixed_cost", "delay_demand", "vehicle_id", "default_demand",
    "label",
]

# --- fixed values -------------------------------------------------------------
EARTH_RADIUS_KM = 6371.0
DEFAULT_LATLON = (39.8, -98.5)                        # coordinate lookup default
TYPE_CODES = {"A": 0, "B": 1, "C": 2}                  # store type codes
SHIP_MODE_CODES = {"Same Day": 0, "First Class": 1, "Second Class": 2,
                   "Standard Class": 3}                # ship mode codes
SHIP_MODE_DEFAULT = 3
SYNTH_LAT_RANGE = (25.0, 48.0)                         # synthetic coordinates
SYNTH_LON_RANGE = (-124.0, -71.0)
HOLIDAY_WEEKS = (6, 36, 47, 52)                        # test-data holiday weeks
# -------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def calendar_parts(d) -> dict[str, Column]:
    """Year, Month, Week (ISO), DayOfYear, Quarter of a date."""
    d = _c(d)
    return {
        "Year": F.year(d),
        "Month": F.month(d),
        "Week": F.weekofyear(d),
        "DayOfYear": F.dayofyear(d),
        "Quarter": F.quarter(d),
    }


def add_weeks(d, weeks) -> Column:
    """Date plus a (column or int) number of weeks."""
    w = weeks if isinstance(weeks, Column) else F.lit(int(weeks))
    return F.date_add(_c(d), w * 7)


def date_text(d) -> Column:
    """Yyyy-MM-dd text of a date."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def lead_time_days(ship, order) -> Column:
    """Whole days between two dates."""
    return F.datediff(F.to_date(_c(ship)), F.to_date(_c(order)))


def fill_zero(c, value=0.0) -> Column:
    """Null -> constant."""
    return F.coalesce(_c(c), F.lit(value))


def optional_zero(columns: list[str], name: str) -> Column:
    """Existing column with nulls filled by 0, else a literal 0."""
    if name in columns:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return F.lit(0.0)


def bool_to_int(c) -> Column:
    """C11: boolean -> 0/1."""
    return _c(c).cast("int")


def code_map(c, mapping: Mapping, default=None) -> Column:
    """Dictionary code lookup with an optional default."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    looked = F.try_element_at(m, _c(c))
    return looked if default is None else F.coalesce(looked, F.lit(default))


def yes_flag(c) -> Column:
    """C14: 1 when trimmed lower-case text equals 'yes' (null -> 0)."""
    return F.coalesce((F.lower(F.trim(_c(c))) == F.lit("yes")).cast("int"), F.lit(0))


def hash_coordinates(*parts) -> tuple[Column, Column]:
    """C17: deterministic coordinates from text keys, no UDF.

    md5 of the parts joined by '_' ; the first 8 hex digits give the latitude
    and the next 8 the longitude, each scaled into the synthetic ranges.
    The same expression runs in DuckDB, which makes it oracle-checkable.
    """
    h = F.md5(F.concat_ws("_", *[_c(p).cast("string") for p in parts]))
    a = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    b = F.conv(F.substring(h, 9, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    lat = F.lit(SYNTH_LAT_RANGE[0]) + a * F.lit(SYNTH_LAT_RANGE[1] - SYNTH_LAT_RANGE[0])
    lon = F.lit(SYNTH_LON_RANGE[0]) + b * F.lit(SYNTH_LON_RANGE[1] - SYNTH_LON_RANGE[0])
    return lat, lon


def clamp_zero(c) -> Column:
    """C20: max(0, x)."""
    return F.greatest(F.lit(0.0), _c(c))


def round2(c, half_even: bool = False) -> Column:
    """Round to 2 decimals (half-even like Python when asked)."""
    return F.bround(_c(c), 2) if half_even else F.round(_c(c), 2)


def ceil_floor_zero(c) -> Column:
    """max(0, ceil(x)) as an integer."""
    return F.greatest(F.lit(0), F.ceil(_c(c)).cast("int"))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km (radius 6371)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def scale_when(c, factor, cond: Column | None = None) -> Column:
    """Multiply by a factor, for all rows or where cond holds."""
    f = factor if isinstance(factor, Column) else F.lit(float(factor))
    if cond is None:
        return _c(c) * f
    return F.when(cond, _c(c) * f).otherwise(_c(c))


def guarded_ratio(num, den) -> Column:
    """Num / max(den, 1)."""
    return _c(num) / F.greatest(_c(den), F.lit(1.0))


def pct_change(new, base) -> Column:
    """(new / max(base, 1) - 1) * 100."""
    return (guarded_ratio(new, base) - F.lit(1.0)) * F.lit(100.0)


def fixed_cost(order, cost) -> Column:
    """Fixed ordering cost charged when the order exceeds 0.01."""
    k = cost if isinstance(cost, Column) else F.lit(float(cost))
    return F.when(_c(order) > F.lit(0.01), k).otherwise(F.lit(0.0))


def delay_demand(weekly, days) -> Column:
    """Weekly demand -> demand during a delay of ``days``."""
    d = days if isinstance(days, Column) else F.lit(float(days))
    return _c(weekly) / F.lit(7.0) * d


def vehicle_id(depot_idx, vehicle_no) -> Column:
    """C29: 'V{depot+1}_{vehicle+1}' from 0-based numbers."""
    return F.format_string("V%d_%d", _c(depot_idx) + 1, _c(vehicle_no) + 1)


def default_demand(demand, key, lo: int = 1000, hi: int = 10000) -> Column:
    """Missing demand -> deterministic integer in [lo, hi) from the key."""
    seeded = F.lit(lo) + F.pmod(F.xxhash64(_c(key)), F.lit(hi - lo))
    return F.coalesce(_c(demand), seeded.cast("double"))


def label(prefix: str, key, name) -> Column:
    """C16: 'Store 7 — Denver, CO' when a name is known, else 'Store 7'."""
    k = _c(key).cast("int").cast("string")
    nm = _c(name)
    return F.when(F.coalesce(F.length(nm), F.lit(0)) > 0,
                  F.concat(F.lit(prefix + " "), k, F.lit(" \u2014 "), nm)) \
        .otherwise(F.concat(F.lit(prefix + " "), k))
