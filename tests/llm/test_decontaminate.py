from collections import Counter

from usagelens.llm.decontaminate import contamination, drop_contaminated

from .brute import DOCS, docs_frame, edge_rows, prose
from .brute import contamination as brute

ITEMS = "item_id long, text string, n_hit long, cls string"


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)


def compare(spark, rows, items):
    got = contamination(docs_frame(spark, rows), items_frame(spark, items)).collect()
    want = brute([(i, t) for i, t, _ in rows], items)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == Counter((row[0], n, h, tuple(x)) for row, (n, h, x) in zip(rows, want, strict=True))
    assert all(sum(s.hi - s.lo for s in r.spans) == r.n_hit for r in got)


def test_windows_and_short_items(spark):
    long, short = prose(50, 45), "only three words"
    w = long.split()
    items = [(1, long), (2, long), (2, long), (3, short), (4, "one"), (5, None), (6, ""), (None, prose(51, 30)), (7, "two words"), (8, prose(52, 10)), (9, "a a a a a a a a a a a a a")]
    rows = edge_rows() + [
        (20, f"{prose(60)} {long} {prose(61)}", "en"),
        (21, f"{prose(62)} {' '.join(w[5:15])} x {' '.join(w[20:29])}", "en"),
        (22, " ".join(w[:9]), "en"),
        (23, f"ONLY, three--WORDS and two words", "en"),
        (24, f"{' '.join(w[:20])} {' '.join(w[10:30])}", "en"),
        (25, "a " * 30, "en"),
        (26, prose(52, 10), "en"),
        (27, prose(51, 30), "en"),
    ]
    compare(spark, rows, items)


def test_one_passage_in_many_documents(spark):
    passage = prose(70, 30)
    rows = [(i, f"{prose(i, 20)} {passage if i % 3 == 0 else ''} {prose(i + 500, 20)}", "en") for i in range(150)]
    compare(spark, rows, [(1, passage), (2, prose(71, 40)), (3, passage + " and more of it")])


def test_empty_tables(spark):
    compare(spark, edge_rows(), [])
    assert contamination(spark.createDataFrame([], DOCS), items_frame(spark, [(1, prose(1))])).count() == 0


def test_drop_contaminated(spark):
    rows = edge_rows() + [(5, f"{prose(80)} {prose(81, 12)}", "en")]
    kept = drop_contaminated(docs_frame(spark, rows), items_frame(spark, [(1, prose(81, 12))]))
    assert kept.columns == docs_frame(spark, rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in edge_rows())


def test_one_id_with_two_texts(spark):
    # b's shingles are rarer in the documents than a's and lie at the same places
    a, b = prose(90, 30), prose(91, 30)
    rows = [(i, f"{prose(100 + i)} {a}", "en") for i in range(6)] + [(50, f"{prose(150)} {b}", "en"), (51, prose(151), "en")]
    compare(spark, rows, [(1, a), (1, b), (2, a)])
