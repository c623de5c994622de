"""Exact k nearest neighbours inside one table (squared Euclidean distance).

A metric tree of two levels prunes the search by the triangle inequality:

1. at most ``MAX_PIVOTS`` points (chosen by a hash) are pivots; every point belongs
   to the cell of its nearest pivot.  In each cell some of its points (one for
   ``LEAF_ROWS``, at most about ``MAX_PIVOTS``) are pivots of leaves, and a point belongs
   to the leaf of the nearest one; cells and leaves know their radius;
2. a point's k-th distance is bounded by the points of its own leaf and by the leaf
   pivots of its cell;
3. the point is sent, with that bound, only to leaves that may hold a closer one: first
   the cells, then the leaves of those cells, whose ball about the pivot comes within the
   bound, and whose side of the plane halfway to the pivot nearest to the point does;
4. each leaf (a chunk of at most about ``block_rows`` points of it) is held by one
   task, the points sent to it stream past, and only the ``k`` best ids and
   distances within the bound per point and chunk leave it;
5. a top-k per point over the chunks it visited is the answer, to which the
   neighbours' vectors are joined.

No pair rows are made.  A task routes one chunk and passes its rows on ``_SENT_ROWS`` at a
time; there is a task of the search for ``TASK_ROWS`` points, so that what one holds does
not grow with the points.  The tree (at most about ``MAX_PIVOTS`` ** 2 vectors) goes to the
tasks as one broadcast.  How many leaves a point visits depends on the data (``visits``
counts them): few in low dimensions, all of them where distances hardly differ
(then the work is n^2 and each point travels once per chunk).

Order: distance (compared after rounding to ``DIST_DECIMALS`` decimals, so
mathematically equal distances tie on every engine), then neighbour id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.session import stored

DIST_DECIMALS = 9
MAX_PIVOTS = 256
LEAF_ROWS = 256
#: Points whose leaves one task of the search holds, about.
TASK_ROWS = 16_384
_QUERY_CHUNK = 256
#: Rows that a routing task gathers before it passes them on, about.
_SENT_ROWS = 32_768
_SLACK = 1e-6


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances, summed left to right over the features."""
    d = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j : j + 1] - b[None, :, j]
        d += diff * diff
    return np.round(d, DIST_DECIMALS)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


@dataclass
class Tree:
    """Pivots of cells and leaves; ``cell_of`` is ascending, so the leaves of a cell are one slice."""

    cells: np.ndarray
    leaves: np.ndarray
    cell_of: np.ndarray
    cell_radius: np.ndarray
    leaf_radius: np.ndarray

    def slice(self, cell: int) -> slice:
        return slice(*np.searchsorted(self.cell_of, [cell, cell + 1]))


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((a[:, None, :] - b[None]) ** 2).sum(axis=2), 0))


def _may_hold(q: np.ndarray, reach: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each point and pivot, whether a point that belongs to the pivot (its nearest one, within ``radius``) can lie within ``reach``."""
    d = _far(q, pivots)
    ball = np.isfinite(radius)[None] & (d - radius - _SLACK <= reach[:, None])
    # what belongs to a pivot lies on its side of the plane halfway to any other, here the one nearest to the point
    first = d.argmin(axis=1)
    gap = _far(pivots[first], pivots)
    beyond = (d**2 - d[np.arange(len(d)), first][:, None] ** 2) / (2 * np.maximum(gap, _SLACK))
    return ball & ((gap <= _SLACK) | (beyond - _SLACK <= reach[:, None]))


def _planted(pts: DataFrame, n: int, width: int) -> tuple[DataFrame, Tree, list[int]]:
    """Points with their cell and leaf, the tree, and the number of points of each leaf."""
    sc = pts.sparkSession.sparkContext
    n_cells = min(MAX_PIVOTS, math.ceil(math.sqrt(max(n, 1) / LEAF_ROWS)))
    chosen = pts.orderBy(F.xxhash64("pid"), "pid").limit(n_cells).collect()  # at most MAX_PIVOTS vectors
    cells = np.array([r["vec"] for r in chosen], dtype=np.float64).reshape(len(chosen), width)

    def to_cells(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 4096):
                part = pdf.iloc[at : at + 4096]
                d = _far(_matrix(part["vec"]), cells)
                yield pd.DataFrame({"pid": part["pid"], "vec": part["vec"], "cell": d.argmin(axis=1).astype("int32"), "reach": d.min(axis=1)})

    pivot_ids = [r["pid"] for r in chosen]
    celled = stored(pts.mapInPandas(to_cells, "pid string, vec array<double>, cell int, reach double"), "knn-cells")
    cell_radius, share = np.full(len(cells), -np.inf), np.zeros(len(cells))
    for r in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).collect():  # one row a cell
        cell_radius[r["cell"]] = r["radius"]
        share[r["cell"]] = min(MAX_PIVOTS / r["n"], 1 / LEAF_ROWS)
    # a cell's leaves grow from about every LEAF_ROWS-th of its points, and from its own pivot
    part_of = F.element_at(F.array(*[F.lit(float(x)) for x in share] or [F.lit(0.0)]), F.col("cell") + 1)
    draw = F.pmod(F.xxhash64("pid", F.lit("leaf")), F.lit(1 << 30)) < part_of * (1 << 30)
    # each pivot once: the bound counts them as different points
    drawn = celled.where(draw & ~F.col("pid").isin(pivot_ids)).select("cell", "vec").limit(2 * MAX_PIVOTS**2).collect()
    both = sorted([(c, *v) for c, v in enumerate(cells.tolist())] + [(r["cell"], *r["vec"]) for r in drawn])
    flat = np.array(both, dtype=np.float64).reshape(len(both), width + 1)
    tree = Tree(cells, flat[:, 1:], flat[:, 0].astype(int), cell_radius, np.full(len(flat), -np.inf))
    sent = sc.broadcast(tree)

    def to_leaves(batches):
        t = sent.value
        for pdf in batches:
            v, cell = _matrix(pdf["vec"]), pdf["cell"].to_numpy()
            leaf, reach = np.zeros(len(pdf), dtype="int32"), np.zeros(len(pdf))
            for c in np.unique(cell):
                rows, own = np.flatnonzero(cell == c), t.slice(c)
                for at in range(0, len(rows), 4096):
                    d = _far(v[rows[at : at + 4096]], t.leaves[own])
                    leaf[rows[at : at + 4096]], reach[rows[at : at + 4096]] = own.start + d.argmin(axis=1), d.min(axis=1)
            yield pd.DataFrame({"pid": pdf["pid"], "vec": pdf["vec"], "leaf": leaf, "reach": reach})

    leaved = stored(celled.mapInPandas(to_leaves, "pid string, vec array<double>, leaf int, reach double"), "knn-leaves")
    sizes = [0] * len(flat)
    for r in leaved.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).collect():  # one row a leaf
        tree.leaf_radius[r["leaf"]], sizes[r["leaf"]] = r["radius"], r["n"]
    return leaved, tree, sizes


def _routes(points: DataFrame, id_col: str, feature_cols: list[str], k: int, block_rows: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Stored points (pid, vec); where each is held (leaf, chunk); the leaves and chunks each must be sent to, with
    the most that its k-th distance can be; and the number of tasks to search them in."""
    pts = points.select(F.col(id_col).cast("string").alias("pid"), F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("vec"))
    pts = stored(pts, "knn-points")
    n = pts.count()
    leaved, tree, sizes = _planted(pts, n, len(feature_cols))
    sent = pts.sparkSession.sparkContext.broadcast(tree)
    large = {i: math.ceil(n / block_rows) for i, n in enumerate(sizes) if n > block_rows}
    chunk_table = pts.sparkSession.createDataFrame(list(large.items()), "leaf int, chunks int")  # only leaves of several chunks
    with_chunks = lambda df: df.join(F.broadcast(chunk_table), "leaf", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    refs = with_chunks(leaved.select("pid", "vec", "leaf")).select("pid", "vec", "leaf", F.pmod(F.xxhash64("pid"), "chunks").cast("int").alias("chunk"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, held = sent.value, pa.Table.from_batches(batches).combine_chunks()
        pid, vec = held["pid"].combine_chunks(), held["vec"].combine_chunks()
        v = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), -1)
        own = t.slice(t.cell_of[held["leaf"][0].as_py()])
        at, to, far = [], [], []

        def gathered() -> pa.RecordBatch:
            rows = np.concatenate(at)
            columns = [pid.take(pa.array(rows)), vec.take(pa.array(rows)), pa.array(np.concatenate(to), pa.int32()), pa.array(np.concatenate(far))]
            for x in (at, to, far):
                x.clear()
            return pa.RecordBatch.from_arrays(columns, names=["pid", "vec", "leaf", "bound"])

        for s in range(0, len(v), _QUERY_CHUNK):
            q = v[s : s + _QUERY_CHUNK]
            bound = np.full(len(q), np.inf)
            for known in (v, t.leaves[own]):
                if len(known) > k:  # the point itself may be one of the k + 1
                    bound = np.minimum(bound, np.partition(_squared(q, known), k, axis=1)[:, k])
            reach = np.sqrt(bound + 10.0**-DIST_DECIMALS) + _SLACK  # distances tie after rounding
            may = _may_hold(q, reach, t.cells, t.cell_radius)
            for c in np.flatnonzero(may.any(axis=0)):
                rows, leaves = np.flatnonzero(may[:, c]), t.slice(c)
                r, leaf = np.nonzero(_may_hold(q[rows], reach[rows], t.leaves[leaves], t.leaf_radius[leaves]))
                at.append(rows[r] + s)
                to.append(leaf + leaves.start)
                far.append(bound[rows[r]])
                if sum(map(len, at)) >= _SENT_ROWS:
                    yield gathered()
        if at:
            yield gathered()

    routed = refs.groupBy("leaf", "chunk").applyInArrow(route, "pid string, vec array<double>, leaf int, bound double")
    routed = with_chunks(routed).select("pid", "vec", "leaf", "bound", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    held = sum(large.get(i, 1) for i, size in enumerate(sizes) if size)
    tasks = max(math.ceil(n / TASK_ROWS), min(held, pts.sparkSession.sparkContext.defaultParallelism), 1)
    return pts, refs, routed, tasks


def visits(points: DataFrame, id_col: str, feature_cols: list[str], k: int, block_rows: int = 2048) -> DataFrame:
    """One row: points, leaves, and how many rows the search would send to leaves (leaves visited, a chunk counting once)."""
    _, refs, routed, _ = _routes(points, id_col, feature_cols, k, block_rows)
    held = refs.agg(F.count(F.lit(1)).alias("points"), F.countDistinct("leaf", "chunk").alias("leaves"))
    return held.withColumn("sent_rows", routed.agg(F.count(F.lit(1))).scalar())


def exact_knn(points: DataFrame, id_col: str, feature_cols: list[str], k: int, block_rows: int = 2048) -> DataFrame:
    """(id, neighbor_rank 1..k, neighbor_id, distance, neighbor_vec) for every point.

    A point with fewer than ``k`` other points gets all of them.
    """
    pts, refs, routed, tasks = _routes(points, id_col, feature_cols, k, block_rows)
    both = refs.withColumns({"bound": F.lit(0.0), "role": F.lit(0)}).unionByName(routed.withColumn("role", F.lit(1)))
    both = both.repartition(tasks, "leaf", "chunk").sortWithinPartitions("leaf", "chunk", "role", "pid")

    def best(ids: np.ndarray, q: np.ndarray, bound: np.ndarray, ref_ids: np.ndarray, ref: np.ndarray) -> pd.DataFrame:
        out = []
        for s in range(0, len(q), _QUERY_CHUNK):
            part = slice(s, s + _QUERY_CHUNK)
            d = _squared(q[part], ref)
            row, col = np.nonzero(d <= bound[part][:, None])
            dist = d[row, col]
            order = np.lexsort((dist, row))  # references come in id order: the first among equals has the smallest id
            row, col, dist = row[order], col[order], dist[order]
            first = np.arange(len(row)) - np.searchsorted(row, row) <= k  # the point itself may be one of the k + 1
            found = pd.DataFrame({"qid": ids[part][row[first]], "nid": ref_ids[col[first]], "dist": dist[first]})
            out.append(found[found["qid"] != found["nid"]])
        return pd.concat(out)

    def search(batches):
        key, ref_ids, ref = None, [], []
        for pdf in batches:
            for (leaf, chunk, role), part in pdf.groupby(["leaf", "chunk", "role"], sort=True):
                if (leaf, chunk) != key:
                    key, ref_ids, ref = (leaf, chunk), [], []
                if role == 0:
                    ref_ids.append(part["pid"].to_numpy())
                    ref.append(_matrix(part["vec"]))
                elif ref:
                    ref_ids, ref = [np.concatenate(ref_ids)], [np.concatenate(ref)]
                    yield best(part["pid"].to_numpy(), _matrix(part["vec"]), part["bound"].to_numpy(), ref_ids[0], ref[0])

    candidates = both.mapInPandas(search, "qid string, nid string, dist double")
    # A point has at most k + 1 candidates from each chunk it visited.
    w = Window.partitionBy("qid").orderBy("dist", "nid")
    ranked = candidates.withColumn("neighbor_rank", F.row_number().over(w)).where(F.col("neighbor_rank") <= k)
    found = ranked.join(pts.select(F.col("pid").alias("nid"), F.col("vec").alias("neighbor_vec")), "nid")
    return found.select(
        F.col("qid").alias(id_col), F.col("neighbor_rank").cast("int").alias("neighbor_rank"), F.col("nid").alias("neighbor_id"), F.col("dist").alias("distance"), "neighbor_vec"
    )
