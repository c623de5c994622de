import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.operators import kmeans
from usagelens.plans import segments

COLS = ["a", "b"]


def blobs(spark, centres, n=120, spread=0.3, seed=1):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, spread, (n, 2)) for c in centres])
    rows = [(f"u{i}", float(p), float(q)) for i, (p, q) in enumerate(x)]
    return spark.createDataFrame(rows, "user_id string, a double, b double").repartition(5), x


def lloyd(x, c, tol, rounds=300):
    """Plain k-means from given centroids: (centroids, cost)."""
    for _ in range(rounds):
        to = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[to == i].mean(axis=0) if (to == i).any() else c[i] for i in range(len(c))])
        shift, c = ((moved - c) ** 2).sum(), moved
        if shift <= tol:
            break
    return c, ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_every_start_follows_plain_k_means(spark):
    df, x = blobs(spark, [(0, 0), (4, 0), (0, 4), (4, 4)], spread=1.5)
    rows = df.select(F.col("a").alias("f0"), F.col("b").alias("f1"), F.xxhash64("user_id").alias("h"))
    specs = [(4, 1), (4, 2), (2, 1), (7, 5)]
    seeded = kmeans._seeded(rows, COLS, specs)
    starts = kmeans.fit(df, COLS, "user_id", specs)
    for s, first in zip(starts, seeded, strict=True):
        assert len(np.unique(first.centroids, axis=0)) == s.k
        assert all((x == c).all(axis=1).any() for c in first.centroids)  # seeds are rows
        c, cost = lloyd(x, first.centroids, 1e-4 * x.var(axis=0).mean())
        assert np.allclose(s.centroids, c) and s.cost == pytest.approx(cost)


def test_seeding_prefers_far_rows_and_is_repeatable(spark):
    df, _ = blobs(spark, [(0, 0), (50, 0), (0, 50)], spread=0.1)
    starts = kmeans.fit(df, COLS, "user_id", [(3, s) for s in range(8)])
    again = kmeans.fit(df.repartition(2), COLS, "user_id", [(3, s) for s in range(8)])
    assert all(np.allclose(a.centroids, b.centroids) for a, b in zip(starts, again, strict=True))
    assert all(s.cost < 20 for s in starts)  # every start found the three groups
    assert len({tuple(np.round(s.centroids.ravel(), 6)) for s in starts}) > 1  # from different seeds


def test_one_scan_a_round_for_all_starts(spark, monkeypatch):
    df, _ = blobs(spark, [(0, 0), (5, 5)])
    rounds, made = [], kmeans._sums
    monkeypatch.setattr(kmeans, "_sums", lambda rows, cols, starts: rounds.append(len(starts)) or made(rows, cols, starts))
    starts = kmeans.fit(df, COLS, "user_id", [(2, s) for s in range(6)])
    assert len(rounds) == max(s.rounds for s in starts) + 1 and rounds[0] == 6


def test_fewer_distinct_rows_than_clusters(spark):
    df = spark.createDataFrame([(f"u{i}", float(i % 2), 1.0) for i in range(10)], "user_id string, a double, b double")
    s = kmeans.fit(df, COLS, "user_id", [(4, 1)])[0]
    assert s.cost == 0 and len(s.centroids) == 4
    with pytest.raises(ValueError, match="rows"):
        kmeans.fit(df.where("a > 5"), COLS, "user_id", [(2, 1)])


def test_nearest_expression(spark):
    df, x = blobs(spark, [(0, 0), (3, 3)])
    c = np.array([[0.0, 0.0], [3.0, 3.0], [9.0, 9.0]])
    got = {r.user_id: r.c for r in df.withColumn("c", kmeans.nearest(COLS, c)).collect()}
    to = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert got == {f"u{i}": int(k) for i, k in enumerate(to)}
    tie = spark.createDataFrame([(1.5, 1.5)], "a double, b double").select(kmeans.nearest(COLS, c).alias("c")).first()
    assert tie.c == 0


def test_best_start_and_knee():
    make = lambda cost, seed: kmeans.Start(2, seed, np.zeros((2, 2)), cost)
    assert segments.best_start([make(3.0, 1), make(2.0, 2), make(2.0, 3)]).seed == 2
    assert segments.knee([2, 3, 4, 5, 6], [100, 60, 20, 15, 10]) == 4
    assert segments.knee([2, 3], [5.0, 1.0]) == 2 and segments.knee([2, 3, 4], [1.0, 1.0, 1.0]) == 2


def test_closest_is_the_first_of_the_nearest():
    rng = np.random.default_rng(3)
    x, c = rng.integers(0, 4, (500, 3)).astype(float), rng.integers(0, 4, (6, 3)).astype(float)  # many ties
    d = sum((x[:, j : j + 1] - c[None, :, j]) ** 2 for j in range(3))
    to, near = kmeans._closest(np.ascontiguousarray(x.T), c)
    assert (to == d.argmin(axis=1)).all() and (near == d.min(axis=1)).all()


def test_a_round_reads_the_features_only(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "f0 double, f1 double").withColumn("h", F.raise_error(F.lit("not needed")).cast("bigint"))
    n, sums, cost = kmeans._sums(rows, COLS, {0: kmeans.Start(1, 1, np.zeros((1, 2)))})[0]
    assert n.tolist() == [2.0] and sums.tolist() == [[1.0, 1.0]] and cost == 2.0
