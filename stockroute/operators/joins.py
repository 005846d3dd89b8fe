"""Join helpers (section E): lookups with defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str,
                        defaults: dict[str, object]) -> DataFrame:
    """Left lookup join on ``key`` with a default per value column.

    Whether ``dim`` is broadcast is left to the planner, which goes by its size
    in bytes, at run time too.
    """
    vals = [c for c in dim.columns if c != key]
    tmp = {c: f"__lk_{c}" for c in vals}
    d = dim.select(F.col(key), *[F.col(c).alias(tmp[c]) for c in vals])
    out = df.join(d, key, "left")
    for c in vals:
        expr = F.col(tmp[c])
        if c in defaults:
            expr = F.coalesce(expr, F.lit(defaults[c]))
        out = out.withColumn(c, expr).drop(tmp[c])
    return out
