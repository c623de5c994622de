from collections import Counter

import numpy as np
import pytest

from usagelens.llm import _blocks
from usagelens.llm.embedding_dedup import CORNERS, STRANGERS, buckets, embedding_groups, hadamard, sizes

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, class string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, 1, "x") for i, v, k in rows], SCHEMA).repartition(3)


def brute(rows, threshold=0.93):
    unit = []
    for _, v, k in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, np.float32).astype(float)
        fine = x is not None and k is not None and len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.linalg.norm(x) if fine else None)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, *_) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), key) if x is not None), default=None)
    return Counter((row[0], links[i], least[find(i)]) for i, row in enumerate(rows))


def compare(spark, rows):
    got = embedding_groups(frame(spark, rows)).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def near(rng, x, cosine):
    g = rng.normal(size=len(x))
    x = x / np.linalg.norm(x)
    g -= (g @ x) * x
    return cosine * x + np.sqrt(1 - cosine**2) * g / np.linalg.norm(g)


def test_edges(spark):
    v, w = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.1]
    nan, inf = float("nan"), float("inf")
    compare(
        spark,
        [(5, v, 1), (6, w, 1), (7, v, 2), (8, v, None), (9, None, 1), (10, [0.0] * 4, 1), (11, [nan, 1.0, 1.0, 1.0], 1), (12, [inf, 1.0, 1.0, 1.0], 1), (13, [1.0, None, 3.0, 4.0], 1), (14, [], 1),
         (15, v[:3], 1), (15, v, 1), (15, v, 1), (None, v, 1), (None, [9.0, -1.0, 0.5, 2.0], 1), (None, None, None), (3, [2.0, 4.0, 6.0, 8.0], 1), (16, [-1.0, -2.0, -3.0, -4.0], 1)],
    )
    assert embedding_groups(frame(spark, [])).count() == 0


def test_links_around_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows, key = [], 0
    for c in (0.9299, 0.9301, 0.94, 0.99):
        for _ in range(60):
            x = rng.normal(size=64)
            for v in (x, near(rng, x, c)):
                rows.append((key, v.tolist(), key % 2 // 2))
                key += 1
    compare(spark, rows)


def test_one_group_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(_blocks, "BLOCK", 16)
    rng = np.random.default_rng(6)
    x = rng.normal(size=64)
    compare(spark, [(i, near(rng, x, 0.97).tolist(), 1) for i in range(120)])


@pytest.mark.parametrize(("dim", "pairs", "n"), [(64, 4000, 10_000), (64, 3000, 50_000), (64, 500, 10_000_000), (384, 400, 50_000), (768, 200, 50_000), (3, 500, 1000)])
def test_recall_of_the_planned_tables(dim, pairs, n):
    """Pairs just at the threshold meet in some bucket, for few and many, short and long vectors."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(pairs, dim))
    y = np.array([near(rng, v, 0.93) for v in x])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label, planned = np.zeros(len(x), np.uint64), sizes(n, dim, 0.93)
    a, b = buckets(x, label, **planned), buckets(y, label, **planned)
    met = np.array([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b, strict=True)])
    assert met.mean() > 0.9999
    assert np.allclose(np.linalg.norm(hadamard(np.eye(128)), axis=0), 1)


def test_chance_meetings_are_bounded():
    """Unrelated vectors share a bucket with few others, among few and among many: more vectors, more hashes."""
    rng = np.random.default_rng(9)
    hashes = []
    for n in (200, 16_000, 70_000):
        x = rng.normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        planned = sizes(n, 64, 0.93) | {"tables": 2}
        _, size = np.unique(buckets(x, np.zeros(n, np.uint64), **planned), return_counts=True)
        hashes.append(planned["hashes"])
        assert (size * (size - 1)).sum() / size.sum() < 2 * STRANGERS
    assert hashes == sorted(set(hashes))


def test_best_corners_in_order():
    """A table's buckets are those of the highest sums over all choices of corners."""
    rng = np.random.default_rng(10)
    x = rng.normal(size=(50, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.zeros(50, np.uint64)
    every = buckets(x, label, 1, 2, CORNERS**2)  # all choices
    for probes in (1, 3, 8):
        assert (buckets(x, label, 1, 2, probes) == every[:, :probes]).all()


def test_short_and_double_vectors(spark):
    rows = [(i, [float(v) for v in ((i % 3) - 1.0, (i % 2) + 0.5)][: 1 + i % 2], 1) for i in range(30)]
    frame64 = spark.createDataFrame([(i, v, k, 1, "x") for i, v, k in rows], SCHEMA.replace("float", "double")).repartition(3)
    got = embedding_groups(frame64).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
