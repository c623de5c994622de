from collections import Counter

from usagelens.llm._components import components
from usagelens.llm import _blocks
from usagelens.llm.ngram_join import bands_for, keep_one, ngram_groups

from .brute import DOCS, docs_frame, edge_rows, groups, prose


def compare(spark, rows):
    got = ngram_groups(docs_frame(spark, rows)).collect()
    want = groups(rows)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == Counter((row[0], c, n) for row, (c, n) in zip(rows, want, strict=True))
    return got


def near(text, *places):
    w = text.split()
    for p in places:
        w[p] = f"changed{p}"
    return " ".join(w)


def test_bands_reach_the_recall():
    bands, rows = bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 128


def test_edges(spark):
    compare(spark, edge_rows())
    assert ngram_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_groups_of_copies_and_near_copies(spark):
    base = [prose(s, 120) for s in range(12)]
    rows = [(i, base[i % 12], "en") for i in range(60)]
    rows += [(100 + i, near(base[i % 12], 3 + i % 40), "en") for i in range(60)]
    rows += [(200 + i, near(base[0], i % 50, 60 + i % 50), "en") for i in range(40)]
    compare(spark, rows)


def test_large_bucket_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(_blocks, "BLOCK", 16)
    base = prose(5, 150)
    compare(spark, [(i, near(base, i % 140), "en") for i in range(140)])


def test_threshold_is_inclusive(spark):
    # 9 words: 5 n-grams; sharing 4 of 5 + 5 - 4 is 2/3; a longer text with 8 of 10 is 0.8
    w = prose(9, 14).split()
    a = " ".join(w[:13])  # 9 n-grams
    b = " ".join([*w[:12], "other", "x"])  # 10 n-grams, 8 shared: 8 / 11
    c = " ".join(w)  # 10 n-grams, 9 shared with a: 0.9
    d = " ".join(w[:12])  # 8 n-grams, 8 of 10 shared with c: exactly 0.8
    compare(spark, [(1, a, "en"), (2, b, "en"), (3, c, "en"), (4, d, "en")])


def test_keep_one(spark):
    rows = edge_rows() + [(20, prose(1), "en"), (0, near(prose(1), 40), "en")]
    kept = keep_one(docs_frame(spark, rows))
    assert kept.columns == docs_frame(spark, rows).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([0, 2, 3, 4, 5, None, 7, 8, 10])
    assert keep_one(spark.createDataFrame([], DOCS)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100}
