"""Exact medians on any distribution."""

import math
import random
import statistics

import pytest

from stockroute.operators import aggregates as G

INF, WIDE = math.inf, 1.5e308


def _columns():
    rnd = random.Random(5)
    n = 4000
    return {
        "plain": [rnd.gauss(0, 1) for _ in range(n)],
        "ties": [rnd.choice([1.0, 2.0]) for _ in range(n)],
        "one": [7.25] * n,
        "heavy_ends": [0.0] * 1990 + [float(i) for i in range(20)] + [19.0] * 1990,
        "skewed": [10 ** rnd.uniform(-300, 300) for _ in range(n)],
        "wide": [rnd.choice([-WIDE, WIDE, 0.5, 1.5]) for _ in range(n)],
        "wide_halves": [-WIDE] * 2000 + [WIDE] * 2000,
        "top": [WIDE] * n,
        "infinite": [rnd.choice([-INF, INF, 3.0, 4.0]) for _ in range(n)],
        "half_infinite": [1.0] * 2000 + [INF] * 2000,
        "nan": [rnd.choice([math.nan, 1.0, 2.0, 5.0]) for _ in range(n)],
        "nulls": [rnd.choice([None, 3.0, 9.0]) for _ in range(n)],
        "whole": [rnd.randrange(10 ** 12) for _ in range(n)],
        "few": [None] * (n - 2) + [1.0, 4.0],
        "single": [None] * (n - 1) + [4.0],
        "empty": [None] * n,
        "nan_only": [math.nan] * n,
        "both_ends": [-INF] * 2000 + [INF] * 2000,
    }


def _want(values):
    v = sorted(float(x) for x in values if x is not None and not math.isnan(x))
    if not v:
        return None
    a, b = v[(len(v) - 1) // 2], v[len(v) // 2]
    return None if (a, b) == (-INF, INF) else a if a == b else statistics.median([a / 2, b / 2]) * 2


@pytest.fixture(scope="module")
def table(spark):
    cols = _columns()
    kinds = ", ".join(f"{c} {'long' if c == 'whole' else 'double'}" for c in cols)
    return spark.createDataFrame(list(zip(*cols.values())), kinds).repartition(4).cache()


@pytest.mark.parametrize("sketch, values", [(10_000, 200_000), (10_000, 50), (40, 10)])
def test_medians_are_exact(table, monkeypatch, sketch, values):
    """Also where brackets are counted late, and where the sketch is poor."""
    monkeypatch.setattr(G, "SKETCH", sketch)
    monkeypatch.setattr(G, "BRACKET_VALUES", values)
    cols = _columns()
    got = G.exact_medians(table, list(cols))
    for c, v in cols.items():
        want = _want(v)
        assert got[c] == want or got[c] == pytest.approx(want, rel=1e-15), c


def test_wrong_sketches_cost_passes_only(table, monkeypatch):
    real, calls = G._narrowed, []

    def wrong(range_, got):
        span, left, median, known = real(range_, got)
        calls.append(1)
        return ((5.0, 6.0), 1, None, False) if len(calls) <= 2 else (span, left, median, known)
    monkeypatch.setattr(G, "_narrowed", wrong)
    cols = _columns()
    assert G.exact_medians(table, ["plain", "skewed"]) == pytest.approx({c: _want(cols[c]) for c in ("plain", "skewed")})


def test_two_passes_whatever_the_distribution(table, monkeypatch):
    passes = []
    monkeypatch.setattr(G, "_sketched", lambda *a, f=G._sketched: passes.append(1) or f(*a))
    G.exact_medians(table, list(_columns()))
    assert len(passes) == 1
    assert G.exact_medians(table, []) == {}
