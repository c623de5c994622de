"""k-means from many starts at once: one pass over the data advances all of them.

Every start has its own number of clusters and its own centroids.  One aggregate a
round sends nothing but partial sums: a task takes batches of rows, assigns each row
to the nearest centroid of every start, and adds up (start, cluster, rows, sums,
cost); the driver receives one row per start and cluster and moves the centroids.
Seeding is k-means++ for all starts in the same passes: in step j each start draws its
j-th centre with probability proportional to the squared distance to its centres so
far, by the largest ``log(u) / d2`` over the rows (u from a hash of row, start and
step, so a repeated task draws the same).

A start is finished when its centroids' total squared movement is at most ``tol``
times the mean variance of the features; it then takes no part in later rounds.
An empty cluster keeps its centroid.  With n rows, d features and c centroids in all
starts a round costs n * c * d multiplications in numpy and one scan; the
centroids, c * d numbers, are all that travels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROWS = 4096


@dataclass
class Start:
    k: int
    seed: int
    centroids: np.ndarray
    cost: float = np.inf
    rounds: int = 0


def _features(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The features of a batch, one after another in memory: features by rows."""
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for i in range(width)])


def _closest(f: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row (a column of ``f``) the nearest centroid, the lowest of equally near ones, and the squared distance.

    Distances are summed feature by feature (no cancellation), over all rows at a time."""
    to, best = np.zeros(f.shape[1], np.intp), np.full(f.shape[1], np.inf)
    for i, centroid in enumerate(c):
        d = np.zeros(f.shape[1])
        for x, v in zip(f, centroid, strict=True):
            away = x - v
            d += np.multiply(away, away, out=away)
        np.copyto(to, i, where=d < best)
        best = np.minimum(best, d)
    return to, best


def _uniform(batch: pa.RecordBatch, column: int, salt: int) -> np.ndarray:
    """A number in (0, 1) for each row, from its hash and ``salt``."""
    h = batch.column(column).to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    h ^= h >> np.uint64(31)
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _seeded(rows: DataFrame, cols: list[str], specs: list[tuple[int, int]]) -> list[Start]:
    """k-means++ centres of every (k, seed), in max(k) passes."""
    width, centres = len(cols), [np.zeros((0, len(cols))) for _ in specs]
    for step in range(max(k for k, _ in specs)):
        going = [i for i, (k, _) in enumerate(specs) if step < k]
        so_far = [centres[i] for i in going]

        def draw(batches: Iterator[pa.RecordBatch], going=going, so_far=so_far, step=step) -> Iterator[pa.RecordBatch]:
            best = {}
            for batch in batches:
                f = _features(batch, width)
                for i, c in zip(going, so_far, strict=True):
                    near = _closest(f, c)[1] if len(c) else np.ones(f.shape[1])
                    with np.errstate(divide="ignore"):
                        key = np.where(near > 0, np.log(_uniform(batch, width, specs[i][1] * 1_000_003 + step)) / near, -np.inf)
                    if len(key):
                        at = int(key.argmax())
                        if i not in best or key[at] > best[i][0]:
                            best[i] = (float(key[at]), f[:, at].tolist())
            if best:
                yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([b[0] for b in best.values()]), pa.array([b[1] for b in best.values()])], names=["start", "key", "x"])

        drawn = rows.mapInArrow(draw, "start int, key double, x array<double>").groupBy("start").agg(F.max_by("x", F.struct("key", "x")).alias("x"))
        for r in drawn.collect():  # one row a start
            centres[r["start"]] = np.vstack([centres[r["start"]], r["x"]])
    return [Start(k, seed, c) for (k, seed), c in zip(specs, centres, strict=True)]


def _sums(rows: DataFrame, cols: list[str], starts: dict[int, Start]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For each start: rows and feature sums of its clusters, and its cost.  One pass over the data, features only."""
    width = len(cols)
    centroids = {i: s.centroids for i, s in starts.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {i: np.zeros((len(c), width + 2)) for i, c in centroids.items()}
        for batch in batches:
            f = _features(batch, width)
            for at in range(0, f.shape[1], _ROWS):
                part = f[:, at : at + _ROWS]
                for i, c in centroids.items():
                    to, d = _closest(part, c)
                    total[i][:, 0] += np.bincount(to, minlength=len(c))
                    total[i][:, 1] += np.bincount(to, d, len(c))
                    for j in range(width):
                        total[i][:, 2 + j] += np.bincount(to, part[j], len(c))
        flat = [(i, c, row) for i, t in total.items() for c, row in enumerate(t.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int32()), pa.array([f[1] for f in flat], pa.int32()), pa.array([f[2] for f in flat])], names=["start", "cluster", "part"])

    parts = rows.select(*[f"f{i}" for i in range(width)]).mapInArrow(add, "start int, cluster int, part array<double>").groupBy("start", "cluster")
    out = {i: np.zeros((len(s.centroids), width + 2)) for i, s in starts.items()}
    for r in parts.agg(*[F.sum(F.get("part", F.lit(j))).alias(f"s{j}") for j in range(width + 2)]).collect():  # one row a start and cluster
        out[r["start"]][r["cluster"]] = [r[f"s{j}"] for j in range(width + 2)]
    return {i: (t[:, 0], t[:, 2:], float(t[:, 1].sum())) for i, t in out.items()}


def fit(data: DataFrame, cols: list[str], id_col: str, specs: list[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4) -> list[Start]:
    """Fit one k-means per (k, seed) of ``specs`` on ``data``, which is read once a round for all of them.

    Features are numbers without nulls.  A start with fewer distinct rows than clusters repeats centres."""
    rows = data.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(cols)], F.xxhash64(id_col).alias("h"))
    spread = rows.agg(*[F.var_pop(f"f{i}").alias(f"v{i}") for i in range(len(cols))], F.count(F.lit(1)).alias("n")).first()
    if not spread["n"]:
        raise ValueError("k-means needs rows")
    still = tol * float(np.mean([spread[f"v{i}"] or 0.0 for i in range(len(cols))]))
    starts = _seeded(rows, cols, specs)
    going = dict(enumerate(starts))
    for _ in range(max_iter):
        if not going:
            break
        for i, (n, sums, _cost) in _sums(rows, cols, going).items():
            s = starts[i]
            moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], s.centroids)
            shift, s.centroids, s.rounds = float(((moved - s.centroids) ** 2).sum()), moved, s.rounds + 1
            if shift <= still:
                del going[i]
    for i, (_n, _sums_, cost) in _sums(rows, cols, dict(enumerate(starts))).items():
        starts[i].cost = cost
    return starts


def squared_distances(cols: list[str], centroids: np.ndarray) -> Column:
    """array<double>: a row's squared distance to each centroid, as a DataFrame expression."""
    terms = [sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(cols, row, strict=True)), F.lit(0.0)) for row in centroids]
    return F.array(*terms)


def nearest(cols: list[str], centroids: np.ndarray) -> Column:
    """Number of the nearest centroid (the lowest of equally near ones)."""
    d = squared_distances(cols, centroids)
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")
