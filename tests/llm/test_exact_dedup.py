import pytest

from usagelens.llm import exact_dedup
from usagelens.llm.exact_dedup import exact_groups, keep_first

from .brute import DOCS, docs_frame, edge_rows, exact

NAMES = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def compare(spark, rows, parts=3):
    frame = docs_frame(spark, [(i, t, "en") for i, t in rows]).repartition(parts)
    got = exact_groups(frame)
    assert got.columns == NAMES
    assert sorted((tuple(r) for r in got.collect()), key=repr) == exact(rows)


def test_edges(spark):
    rows = [(i, t) for i, t, _ in edge_rows()]
    rows += [(20, "a b"), (21, "a \t\r\n\x0b\x0c b"), (22, "a b"), (23, "a b "), (24, " a b"), (None, "a b"), (25, "A b"), (26, "a\x1cb"), (27, "ab")]
    compare(spark, rows)


def test_empty_table(spark):
    assert exact_groups(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("parts", [1, 16, 17, 40])
def test_rounds(spark, parts):
    """One round, two and three give the same groups; a third of the rows are copies."""
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 400}") for i in range(1500)]
    compare(spark, rows, parts)


def test_small_fan(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FAN", 2)
    compare(spark, [(i, f"text {i % 37}") for i in range(300)], 9)


def test_no_python_on_the_way(spark):
    plan = exact_groups(docs_frame(spark, [(1, "a", "en")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_merge_needs_no_exchange_of_its_own(spark):
    rows = spark.createDataFrame([(0, "ab", 1, 1, (False, 1, 1), 1)], "run int, digest string, size int, mark long, least struct<nameless:boolean,doc_id:long,row:long>, n long")
    plan = exact_dedup._merged(rows, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" in plan


def test_keep_first(spark):
    rows = [(3, "x  y"), (1, "x y"), (1, "x y"), (1, "other"), (None, "alone"), (9, None), (8, "")]
    kept = keep_first(docs_frame(spark, [(i, t, "en") for i, t in rows]))
    assert kept.columns[:3] == ["doc_id", "text", "lang"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, "x y"), (1, "other"), (None, "alone"), (8, "")], key=repr)
