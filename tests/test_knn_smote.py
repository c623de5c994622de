import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.operators import knn
from usagelens.operators.knn import DIST_DECIMALS, exact_knn
from usagelens.operators.smote import smote


def _points(spark, n=300, d=4, seed=3, dup=40):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 6, size=(n, d)).astype(float)  # integer grid: many exact ties
    x[:dup] = x[0]  # a block of identical points
    rows = [(f"p{i:04d}", *map(float, x[i])) for i in range(n)]
    cols = [f"f{j}" for j in range(d)]
    return spark.createDataFrame(rows, ["pid"] + cols), x, cols


def _brute(x, ids, k):
    out = {}
    for i in range(len(x)):
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            d = d + (x[i, j] - x[:, j]) ** 2
        d = np.round(d, DIST_DECIMALS)
        cand = sorted((d[m], ids[m]) for m in range(len(x)) if m != i)
        out[ids[i]] = [c[1] for c in cand[:k]]
    return out


@pytest.mark.parametrize("block_rows", [1000, 64])
def test_exact_knn_matches_brute_force(spark, block_rows):
    df, x, cols = _points(spark)
    ids = [f"p{i:04d}" for i in range(len(x))]
    got = exact_knn(df, "pid", cols, 5, block_rows=block_rows)
    by = {}
    for r in got.collect():
        by.setdefault(r.pid, []).append((r.neighbor_rank, r.neighbor_id))
    expect = _brute(x, ids, 5)
    assert {p: [n for _, n in sorted(v)] for p, v in by.items()} == expect


@pytest.mark.parametrize("width", [1, 3, 9])
def test_two_level_tree_matches_brute_force(spark, monkeypatch, width):
    """Many small leaves in several cells, clustered points, outliers and a block of equal points."""
    monkeypatch.setattr(knn, "LEAF_ROWS", 8)
    monkeypatch.setattr(knn, "MAX_PIVOTS", 7)
    rng = np.random.default_rng(width)
    x = np.round(np.concatenate([rng.normal(c, 0.5, (90, width)) for c in (0, 5, 20)] + [rng.normal(0, 100, (10, width)), np.full((30, width), 5.0)]), 2)
    ids, cols = [f"p{i:04d}" for i in range(len(x))], [f"f{j}" for j in range(width)]
    df = spark.createDataFrame([(p, *map(float, v)) for p, v in zip(ids, x, strict=True)], ["pid", *cols])
    got = {}
    for r in exact_knn(df, "pid", cols, 5, block_rows=16).collect():
        got.setdefault(r.pid, []).append((r.neighbor_rank, r.neighbor_id))
    assert {p: [n for _, n in sorted(v)] for p, v in got.items()} == _brute(x, ids, 5)


def test_visits_grow_slower_than_the_points(spark):
    """In two dimensions a point visits about as many leaves however many points there are."""
    rng = np.random.default_rng(5)
    seen = {}
    for n in (3_000, 24_000):
        pts = spark.createDataFrame([(str(i), float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(n, 2)))], "pid string, a double, b double")
        seen[n] = knn.visits(pts, "pid", ["a", "b"], 5).first()
    assert seen[24_000].points == 24_000 and seen[24_000].leaves > 5 * seen[3_000].leaves
    assert seen[24_000].sent_rows / 24_000 < 1.5 * seen[3_000].sent_rows / 3_000


def test_a_point_goes_only_to_leaves_on_its_side(spark):
    """Balls overlap in seven dimensions; the planes between pivots part them, and points with copies need hardly any other leaf."""
    x = np.random.default_rng(8).normal(size=(1_000, 7))
    pts = spark.createDataFrame([(f"{i}#{j}", *map(float, v)) for i, v in enumerate(x) for j in range(8)], ["pid", *[f"f{j}" for j in range(7)]])
    seen = knn.visits(pts, "pid", pts.columns[1:], 5).first()
    assert seen.points == 8_000 and seen.leaves > 20 and seen.sent_rows < 2 * seen.points


def test_search_tasks_grow_with_the_points(spark, monkeypatch):
    monkeypatch.setattr(knn, "TASK_ROWS", 10)
    df, _, cols = _points(spark)
    assert knn._routes(df, "pid", cols, 5, 64)[3] == 30


def test_distances_that_tie_after_rounding(spark, monkeypatch):
    """Points that differ by less than the rounding shows are equally near, in whatever leaf they are."""
    monkeypatch.setattr(knn, "LEAF_ROWS", 4)
    x = np.array([[1e-5 * (i % 3), 2e-5 * (i % 2)] for i in range(60)] + [[5.0, i] for i in range(60)])
    ids = [f"p{(i * 37) % 120:03d}" for i in range(120)]
    df = spark.createDataFrame([(p, *map(float, v)) for p, v in zip(ids, x, strict=True)], "pid string, a double, b double")
    got = {}
    for r in exact_knn(df, "pid", ["a", "b"], 5).collect():
        got.setdefault(r.pid, []).append((r.neighbor_rank, r.neighbor_id))
    assert {p: [n for _, n in sorted(v)] for p, v in got.items()} == _brute(x, ids, 5)


def test_knn_with_fewer_points_than_k(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 3.0)], "pid string, f0 double")
    got = {(r.pid, r.neighbor_rank): r.neighbor_id for r in exact_knn(df, "pid", ["f0"], 5).collect()}
    assert got == {("a", 1): "b", ("a", 2): "c", ("b", 1): "a", ("b", 2): "c", ("c", 1): "b", ("c", 2): "a"}


def test_smote_balances_exactly_and_interpolates(spark):
    rng = np.random.default_rng(7)
    maj = [(f"m{i}", float(a), float(b), 0) for i, (a, b) in enumerate(rng.normal(0, 1, (97, 2)))]
    mino = [(f"x{i}", float(a), float(b), 1) for i, (a, b) in enumerate(rng.normal(3, 1, (13, 2)))]
    df = spark.createDataFrame(maj + mino, "id string, a double, b double, y int")
    out = smote(df, "id", ["a", "b"], "y", 1, k=5, seed=42)
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 97, 1: 97}
    # each synthetic point lies on a segment between its seed point and one of its 5 neighbours
    pts = {r.id: np.array([r.a, r.b]) for r in df.where("y = 1").collect()}
    neigh = {}
    for r in exact_knn(df.where("y = 1"), "id", ["a", "b"], 5).collect():
        neigh.setdefault(r.id, []).append(r.neighbor_id)
    for r in out.where(F.col("is_synthetic")).collect():
        src = r.id.split("#")[0]
        p = np.array([r.a, r.b])
        ok = False
        for nb in neigh[src]:
            v = pts[nb] - pts[src]
            t = np.dot(p - pts[src], v) / np.dot(v, v)
            if -1e-9 <= t <= 1 + 1e-9 and np.allclose(pts[src] + t * v, p, atol=1e-9):
                ok = True
        assert ok, r
    # same seed, same rows
    again = smote(df, "id", ["a", "b"], "y", 1, k=5, seed=42)
    assert out.exceptAll(again).count() == 0


def test_smote_noop_when_balanced(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 1)], "id string, f double, y int")
    assert smote(df, "id", ["f"], "y").count() == 2


def test_smote_tiny_minority_chunks(spark):
    rows = [(f"m{i}", float(i % 17), 0) for i in range(2000)] + [(f"x{i}", 100.0 + i, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "id string, f double, y int")
    out = smote(df, "id", ["f"], "y", 1, k=2, seed=1, chunk_rows=97)
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 2000, 1: 2000}
    assert out.select("id").distinct().count() == 4000
    lo, hi = out.where("is_synthetic").agg(F.min("f"), F.max("f")).first()
    assert 100.0 <= lo and hi <= 102.0


def test_smote_needs_more_rows_than_neighbours(spark):
    rows = [(f"m{i}", float(i), 0) for i in range(20)] + [(f"x{i}", 1.0, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "id string, f double, y int")
    with pytest.raises(ValueError, match="more than 5 minority rows"):
        smote(df, "id", ["f"], "y", 1, k=5)
