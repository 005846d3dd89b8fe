"""A fitted tree ensemble as flat arrays, evaluated in Arrow batches.

Spark's model keeps its trees in the JVM, so each ``transform`` is a pass over a
DataFrame.  Where a prediction feeds the next one (recursive forecasts) the trees
are read once - from the model's public description - into arrays of nodes, which
are small, bounded by the ensemble and sent along with the task.
"""

from __future__ import annotations

import datetime
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers need no installed package

_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)$")
_TREE = re.compile(r"Tree \d+ \(weight (\S+)\):$")


@dataclass(frozen=True)
class FlatTrees:
    """Nodes of all trees in one row each; a leaf is its own child on both sides."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray        # first node of each tree
    weight: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees for each row of ``x`` (rows, features)."""
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for root, weight in zip(self.root, self.weight):
            node = np.full(len(x), root)
            for _ in range(self.depth):
                below = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            out += weight * self.value[node]
        return out


def parse(description: str) -> FlatTrees:
    """Read ``toDebugString`` of a regression ensemble with ordered splits."""
    lines = [line.strip() for line in description.splitlines()]
    lines = [line for line in lines if line and not line.startswith("Else")]
    nodes: list[list] = []
    deepest = 0

    def subtree(at: int, depth: int) -> int:
        """Add the subtree that begins at a line; the line behind it."""
        nonlocal deepest
        me = len(nodes)
        deepest = max(deepest, depth)
        if lines[at].startswith("Predict: "):
            nodes.append([0, np.inf, me, me, float(lines[at][9:])])
            return at + 1
        split = _SPLIT.match(lines[at])
        if not split:
            raise ValueError(f"not an ordered split: {lines[at]}")
        nodes.append([int(split[1]), float(split[2]), me + 1, 0, 0.0])
        at = subtree(at + 1, depth + 1)
        nodes[me][3] = len(nodes)
        return subtree(at, depth + 1)

    roots, weights, at = [], [], 0
    while at < len(lines):
        tree = _TREE.match(lines[at])
        if tree:
            roots.append(len(nodes))
            weights.append(float(tree[1]))
            at = subtree(at + 1, 0)
        else:
            at += 1
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
    return FlatTrees(feature.astype(np.int64), threshold.astype(float), left.astype(np.int64),
                     right.astype(np.int64), value.astype(float), np.array(roots), np.array(weights), deepest)


def flat(model) -> FlatTrees:
    """The trees of a fitted ``GBTRegressionModel``."""
    return parse(model.toDebugString)


def _sum(columns: Sequence[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(columns[0]))
    for c in columns:           # in order, like the array folds of the other steps
        total = total + c
    return total


def tail_features(recent: np.ndarray, size: np.ndarray, n: np.ndarray, first: np.ndarray,
                  lags: Sequence[int], population: bool) -> dict[str, np.ndarray]:
    """Lags and trailing statistics of each series; ``recent`` ends with its last value
    and is padded in front, ``size`` tells how many values it holds."""
    last = lambda k: recent[:, -k]
    out = {f"Sales_Lag_{k}": np.where(n >= k, last(k), first) for k in lags}
    for k in (4, 12):
        held = np.minimum(size, k)
        out[f"Sales_RollingMean_{k}"] = _sum([np.where(held >= j, last(j), 0.0) for j in range(k, 0, -1)]) / held
    mean = out["Sales_RollingMean_4"]
    spread = _sum([(last(j) - mean) * (last(j) - mean) for j in range(4, 0, -1)])
    with np.errstate(invalid="ignore"):
        std = np.sqrt(spread / (4 if population else 3))
    out["Sales_RollingStd_4"] = np.where(n >= 4, std, 0.0)
    return out


def recursive_weeks(ensemble: FlatTrees, features: Sequence[str], lags: Sequence[int], calendar: Sequence[dict],
                    dates: Sequence[datetime.date], tail: int, population: bool):
    """Arrow function: series state in (keys, n, first, recent, frozen features), a row
    for each week out (Store, Dept, Date, p)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows or not dates:
                continue
            rows = b.num_rows
            lists = b["recent"]
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat_ = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
            recent = np.full((rows, tail), np.nan)
            row = np.repeat(np.arange(rows), size)
            place = np.arange(len(flat_)) - np.repeat(np.cumsum(size) - size, size)
            recent[row, tail - size[row] + place] = flat_
            n = b["n"].to_numpy(zero_copy_only=False).astype(np.int64)
            first = b["first"].to_numpy(zero_copy_only=False).astype(float)
            x = np.zeros((rows, len(features)))
            for j, c in enumerate(features):
                if c in b.schema.names:
                    x[:, j] = b[c].to_numpy(zero_copy_only=False)
            out = np.empty((len(dates), rows))
            for w, parts in enumerate(calendar):
                now = {**tail_features(recent, size, n, first, lags, population), **parts}
                for j, c in enumerate(features):
                    if c in now:
                        x[:, j] = np.nan_to_num(now[c], nan=0.0) if isinstance(now[c], np.ndarray) else now[c]
                out[w] = np.maximum(ensemble.predict(x), 0.0)
                recent = np.concatenate([recent[:, 1:], out[w][:, None]], axis=1)
                size, n = np.minimum(size + 1, tail), n + 1
            index = pa.array(np.tile(np.arange(rows), len(dates)))
            yield pa.record_batch(
                [b["_Store"].take(index), b["_Dept"].take(index),
                 pa.array(np.repeat(np.array(dates, "datetime64[D]"), rows)), pa.array(out.ravel())],
                names=["Store", "Dept", "Date", "p"])
    return run
