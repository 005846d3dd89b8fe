"""Aggregations (section F): exact medians, error metrics, histograms, counts.

All aggregates are plain ``groupBy().agg`` so Spark runs a map-side partial
aggregate before the shuffle; hot keys never reach one task as raw rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rank error of the sketch as a share of the rows (Spark's percentile_approx)
SKETCH = 10_000
# shares of a range at which a sketch is asked: evenly, and close around the middle
SHARES = sorted({0.5 - 4 / SKETCH, 0.5 + 4 / SKETCH, *(i / 64 for i in range(65))})
# distinct values of a bracket that may be counted on the driver
BRACKET_VALUES = 200_000


def _middle(a: float, b: float) -> float | None:
    if a == b:
        return a
    mean = (a + b) / 2
    if math.isinf(mean) and not math.isinf(a) and not math.isinf(b):
        mean = a / 2 + b / 2
    return None if math.isnan(mean) else mean


def _sketched(base: DataFrame, ranges: dict[str, tuple]) -> dict[str, dict]:
    """For each column's range: the rows of the column, those below the range and in it,
    the values at SHARES of it, the rows at its ends and the values next to them."""
    aggs = []
    for v, (lo, hi) in ranges.items():
        x = F.col(v)
        over = F.lit(True) if lo is None else x >= lo
        held = over & (F.lit(True) if hi is None else x <= hi)
        aggs += [F.count(x).alias(f"{v}_all"), F.count(F.when(~over, x)).alias(f"{v}_below"),
                 F.count(F.when(held, x)).alias(f"{v}_in"),
                 F.percentile_approx(F.when(held, x), list(SHARES), SKETCH).alias(f"{v}_cuts")]
        if lo is not None:
            aggs += [F.count(F.when(x == lo, x)).alias(f"{v}_low"),
                     F.min(F.when(held & (x > lo), x)).alias(f"{v}_up")]
        if hi is not None:
            aggs += [F.count(F.when(x == hi, x)).alias(f"{v}_high"),
                     F.max(F.when(held & (x < hi), x)).alias(f"{v}_down")]
    row = base.agg(*aggs).first().asDict()
    return {v: {k[len(v) + 1:]: x for k, x in row.items() if k.startswith(f"{v}_")} for v in ranges}


def _narrowed(range_: tuple, got: dict) -> tuple[tuple, float, float | None, bool]:
    """The next range of a column, how many rows it may hold, and its median if that is known."""
    (lo, hi), held = range_, got["in"]
    first, last = (got["all"] - 1) // 2 - got["below"], got["all"] // 2 - got["below"]

    def at(rank: int) -> float | None:
        """The value of a rank that lies at an end of the range, or next to one."""
        if lo is not None and 0 <= rank <= got["low"]:
            return lo if rank < got["low"] else got["up"]
        back = held - 1 - rank
        if hi is not None and 0 <= back <= got["high"]:
            return hi if back < got["high"] else got["down"]
        return None

    a, b = at(first), at(last)
    if a is not None and b is not None:
        return range_, 0, _middle(a, b), True
    error = 2 * held / SKETCH + 1
    below = [i for i, s in enumerate(SHARES) if s * held + error <= first]
    above = [i for i, s in enumerate(SHARES) if s * held - error >= last]
    left = ((SHARES[above[0]] if above else 1) - (SHARES[below[-1]] if below else 0)) * held + 2 * error
    span = (got["cuts"][below[-1]] if below else lo, got["cuts"][above[0]] if above else hi)
    if span == range_ and None in span:             # no more than a few values
        return span, 0, None, False
    if span == range_:                              # ties at both ends, and the ranks between them
        span = (math.nextafter(lo, math.inf), math.nextafter(hi, -math.inf))
    return span, left, None, False


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """exact (interpolated) medians of several columns, distributed.

    One pass sketches all columns (mergeable, with a bounded rank error) and so
    brackets the two middle ranks; the next counts the values below and inside the
    brackets, each value once, and reads the medians off.  Where a bracket may still
    hold more than ``BRACKET_VALUES`` values it is sketched again first.  Ranks that a
    bracket turns out to miss are searched beside it, so the result is exact whatever
    the sketch says.

    Works on any distribution: ties, infinite and very wide columns alike.  NaN counts
    as missing; a column without values has no median, nor has one whose middle values
    are minus and plus infinity.
    """
    names = {f"v{i}": c for i, c in enumerate(cols)}
    base = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(v) for v, c in names.items()])
    out: dict[str, float | None] = {c: None for c in cols}
    rough = {v: (None, None) for v in names}
    ready: dict[str, tuple] = {}
    while rough or ready:
        if rough:
            for v, got in _sketched(base, rough).items():
                if not got["all"]:
                    del rough[v]
                    continue
                span, left, median, known = _narrowed(rough[v], got)
                if known:
                    out[names[v]] = median
                    del rough[v]
                elif left <= BRACKET_VALUES or span[0] is not None and span[0] == span[1]:
                    del rough[v]
                    ready[v] = span
                else:
                    rough[v] = span
            continue
        kinds = []
        for v, (lo, hi) in ready.items():
            x = F.col(v)
            kind = (F.when(F.lit(False) if lo is None else x < lo, -1)
                    .when(F.lit(False) if hi is None else x > hi, 1).otherwise(0))
            kinds.append(F.when(x.isNotNull(), F.struct(F.lit(v).alias("v"), kind.alias("kind"),
                                                        F.when(kind == 0, x).alias("x"))))
        counts = (base.select(F.explode(F.array(*kinds)).alias("r")).where("r is not null")
                  .groupBy("r.v", "r.kind", "r.x").agg(F.count("*").alias("n")).collect())
        for v, (lo, hi) in list(ready.items()):
            own = [r for r in counts if r["v"] == v]
            n, below = sum(r["n"] for r in own), sum(r["n"] for r in own if r["kind"] < 0)
            ranks, found, at = ((n - 1) // 2, n // 2), {}, below
            for value, k in sorted((r["x"], r["n"]) for r in own if r["kind"] == 0):
                found |= {rank: value for rank in ranks if at <= rank < at + k}
                at += k
            del ready[v]
            if all(rank in found for rank in ranks):
                out[names[v]] = _middle(found[ranks[0]], found[ranks[1]])
            else:                           # the sketch was wrong: look on the side that it left out
                rough[v] = (None if ranks[0] < below else lo, None if ranks[1] >= at else hi)
    return out


def regression_metrics(df: DataFrame, label: str, pred: str,
                       by: list[str] | None = None, prefix: str = "") -> DataFrame:
    """F16: MAE, RMSE and R^2 (optionally per group), one partial-aggregate pass.

    R^2 = 1 - SSE / SST with SST = n * var_pop(y); a constant label gives 0/0
    which is reported as null.
    """
    e = F.col(label) - F.col(pred)
    aggs = [
        F.count("*").alias(f"{prefix}n"),
        F.avg(F.abs(e)).alias(f"{prefix}mae"),
        F.sqrt(F.avg(e * e)).alias(f"{prefix}rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.count("*") * F.var_pop(F.col(label))))
        .alias(f"{prefix}r2"),
    ]
    return df.groupBy(*(by or [])).agg(*aggs)


def histogram(df: DataFrame, col: str, bins: int = 100,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """equal-width histogram (bin index, bounds, count).

    Bounds default to the data min/max, taken by one scalar subquery so the
    plan stays one job without a cross join; with bounds, values outside them
    are not counted.
    """
    c = F.col(col)
    ends = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar() if lo is None or hi is None else None
    mn = F.lit(float(lo)) if lo is not None else ends["lo"].cast("double")
    mx = F.lit(float(hi)) if hi is not None else ends["hi"].cast("double")
    # a constant column gets a range of 1 around its value
    mn, mx = (F.when(mn == mx, mn - 0.5).otherwise(mn), F.when(mn == mx, mx + 0.5).otherwise(mx))
    sel = df.where(c.isNotNull()).select(c.cast("double").alias("x"), mn.alias("lo"), mx.alias("hi"))
    if lo is not None or hi is not None:
        sel = sel.where((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    return (sel.groupBy(b.alias("bin"), "lo", "hi").agg(F.count("*").alias("n"))
            .select("bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"), "n"))


def two_way_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    """long-form contingency counts (row value, column value, n)."""
    return df.groupBy(row, col).agg(F.count("*").alias("n"))


def profile(df: DataFrame, keys: tuple[str, str] = ("Store", "Dept"), date_col: str = "Date") -> DataFrame:
    """Rows, distinct stores and departments, first and last date."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(keys[0]).alias("n_stores"),
                  F.count_distinct(keys[1]).alias("n_depts"),
                  F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def last_row(df: DataFrame, keys: list[str], order_col: str, cols: list[str]) -> DataFrame:
    """the last row of each series as columns (max_by on the order), and its length."""
    s = F.max_by(F.struct(*cols), F.col(order_col)).alias("_last")
    return df.groupBy(*keys).agg(s, F.count("*").alias("n_weeks")).select(
        *keys, *[F.col(f"_last.{c}").alias(c) for c in cols], "n_weeks")
