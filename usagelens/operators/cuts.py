"""Borders that cut numeric features into bins of about equal weight, exact and from all rows.

MLlib's trees choose a split among the borders of at most ``maxBins`` bins a feature, and take
those from a sample of some 10,000 rows.  ``borders`` follows the same rule over every row:

* with ``bins`` different values or fewer, a border lies between any two of them;
* else there is one for each of the weights ``k / bins`` of the total: after the value up to which
  the rows weigh nearest to that, or after the next value where that border is taken already;
* a border lies halfway to the next value.

The values at those weights are selected digit by digit: a pass over the rows counts, for each
feature and each beginning of a key that holds a wanted value, the 256 digits that follow.  Keys are
the 64 bits of a double in an order like its own, so eight passes are exact for any numbers.  One more finds
the neighbours of these values.  A task and the driver hold features x bins x 256 numbers at most,
however many rows there are; nothing is sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DIGIT, _KEY = 8, 64
_SIGN = np.uint64(1 << 63)


def _column(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def _keys(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles ``x`` (both zeros are one)."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def _value(key: int) -> float:
    bits = key & ~(1 << 63) if key >> 63 else ~key & ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _digits(rows: DataFrame, shift: int, heads: list[np.ndarray]) -> list[np.ndarray]:
    """For each feature, the weight of the rows by head of their key (the given ones) and digit after it."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(h) << _DIGIT) for h in heads]
        for batch in batches:
            w = _column(batch, len(heads))
            for i, h in enumerate(heads):
                key = _keys(_column(batch, i)) >> np.uint64(shift)
                head = key >> np.uint64(_DIGIT)
                at = np.minimum(np.searchsorted(h, head), len(h) - 1)
                here = h[at] == head
                cell = (at[here] << _DIGIT) + (key[here] & np.uint64((1 << _DIGIT) - 1)).astype(np.intp)
                total[i] += np.bincount(cell, w[here], len(total[i]))
        for i, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at), pa.array(t[at])], names=["feature", "cell", "w"])

    out = [np.zeros(len(h) << _DIGIT) for h in heads]
    parts = rows.mapInArrow(add, "feature int, cell long, w double").groupBy("feature", "cell").agg(F.sum("w").alias("w"))
    for r in parts.collect():  # features x bins x 256 rows at most
        out[r["feature"]][r["cell"]] = r["w"]
    return [t.reshape(len(h), -1) for t, h in zip(out, heads, strict=True)]


def _around(rows: DataFrame, wanted: list[np.ndarray], most: int) -> list[dict[float, tuple[float | None, list[float]]]]:
    """For each feature and each of the values ``wanted``: the value before it and the ``most`` next ones."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0) for _ in wanted]
        for batch in batches:
            for i, values in enumerate(wanted):
                u = np.unique(np.concatenate([seen[i], _column(batch, i) + 0.0]))
                before, after = np.searchsorted(u, values) - 1, np.searchsorted(u, values, "right")
                keep = np.concatenate([before, *(after + j for j in range(most))])
                seen[i] = u[np.unique(keep[(keep >= 0) & (keep < len(u))])]
        found = []
        for i, values in enumerate(wanted):
            u = seen[i]
            for v in values.tolist():
                at, end = np.searchsorted(u, v), np.searchsorted(u, v, "right")
                found += [(i, v, float(u[at - 1]) if at else None, u[end : end + most].tolist())]
        columns = [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "value", "before", "next"])

    out = [{} for _ in wanted]
    parts = rows.mapInArrow(near, "feature int, value double, before double, next array<double>").groupBy("feature", "value")
    merged = parts.agg(F.max("before").alias("before"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("next")))), 1, most).alias("next"))
    for r in merged.collect():  # features x bins rows at most
        out[r["feature"]][r["value"]] = (r["before"], r["next"])
    return out


def borders(data: DataFrame, cols: list[str], weight: str, bins: int) -> list[list[float]]:
    """Ascending borders of each of ``cols`` (numbers without nulls), ``bins - 1`` at most: a value belongs after those up to it."""
    rows = data.select(*[F.col(c).cast("double") for c in cols], F.col(weight).cast("double"))
    targets = heads = None
    for shift in range(_KEY - _DIGIT, -1, -_DIGIT):
        if heads is None:
            heads = [np.zeros(1, np.uint64) for _ in cols]
        counted = _digits(rows, shift, heads)
        if targets is None:  # what the rows weigh before the wanted value, and its key as far as it is known
            total = [t.sum() for t in counted]
            targets = [[(k * t / bins, 0.0, 0, 0.0) for k in range(1, bins)] if t else [] for t in total]
        for i, t in enumerate(counted):
            for k, (goal, below, key, _) in enumerate(targets[i]):
                row = t[np.searchsorted(heads[i], np.uint64(key))]
                upto = below + np.cumsum(row)
                digit = min(int(np.searchsorted(upto, goal)), int(np.flatnonzero(row)[-1]))  # sums of weights are rounded
                targets[i][k] = (goal, upto[digit] - row[digit], key << _DIGIT | digit, upto[digit])
        heads = [np.unique(np.array([key for _, _, key, _ in t], np.uint64)) if t else np.zeros(1, np.uint64) for t in targets]
    wanted = [np.unique([-np.inf, *(_value(key) for _, _, key, _ in t)]) for t in targets]
    around = _around(rows, wanted, bins + 1)
    out = []
    for t, near in zip(targets, around, strict=True):
        values = near.get(-np.inf, (None, []))[1]
        pairs = list(zip(values, values[1:]))  # a border lies between the two
        if len(values) > bins:
            pairs, after = [], []
            for goal, below, key, upto in t:
                v = _value(key)
                before, following = near[v]
                here = [before, v, *following] if before is not None and goal - below < upto - goal else [v, *following]
                if pairs and here[0] <= pairs[-1][0]:
                    here = after
                if len(here) < 2:  # the largest value
                    break
                pairs.append((here[0], here[1]))
                after = here[1:]
        out.append([mid if (mid := (a + b) / 2) > a else b for a, b in pairs])
    return out
