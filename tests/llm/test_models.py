import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.llm import language_id, quality_gam, toxicity
from usagelens.llm._common import held_out
from usagelens.llm._training import training_rows
from usagelens.llm.language_id import identify

from .brute import DOCS, docs_frame, edge_rows, prose

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string, score double"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def auc(score, y):
    order = np.argsort(np.argsort(score))
    n = (y == 1).sum()
    return (order[y == 1].sum() - n * (n - 1) / 2) / (n * (y == 0).sum())


def test_language_held_out_accuracy(docs):
    found = identify(docs, language_id.train(docs)).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 100 and np.mean([r.lang == r.lang_pred for r in found]) > 0.95


def test_language_windows_cover_texts():
    data = np.arange(700, dtype=np.int64).astype(np.uint8)
    w, owner = language_id.windows(data, np.array([0, 600, 600, 700]))
    assert owner.tolist() == [0, 0, 0, 2]
    folded = language_id._FOLD[data]
    assert (w[2] == folded[600 - 256 : 600]).all() and (w[3][:100] == folded[600:]).all() and not w[3][100:].any()


def test_language_edges(spark):
    frame = docs_frame(spark, edge_rows())
    model = language_id.train(frame)
    got = {(r.doc_id, r.lang_pred, r.score) for r in identify(frame, model).collect()}
    assert {(2, "und", 0.0), (3, "und", 0.0), (4, "und", 0.0)} <= got
    assert all(p in (*model.languages, "und") and 0 <= s <= 1 for _, p, s in got)
    empty = spark.createDataFrame([], DOCS)
    assert identify(empty, language_id.train(empty)).count() == 0
    nameless = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in identify(nameless, language_id.train(nameless)).collect()} == {"und"}


def test_labels_of_held_out_documents_do_not_matter(docs, labels):
    from usagelens.llm._common import held_out

    turned = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_gam.train(docs, labels), quality_gam.train(docs, turned)
    assert all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables, strict=True)) and a.pairs == b.pairs


def test_quality_held_out(docs, labels):
    rows = quality_gam.score(docs, quality_gam.train(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    s, y = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert auc(s, y) > 0.97 and ((s >= 0.3) == (y == 1)).mean() > 0.95


@pytest.mark.parametrize("module", [quality_gam, toxicity])
def test_scores_at_the_edges(spark, module):
    frame = docs_frame(spark, edge_rows())
    label = "quality" if module is quality_gam else "toxic"
    some = spark.createDataFrame([(1, 1, 0, "x", 1.0), (5, 0, 1, "x", 1.0), (5, 0, 1, "x", 1.0), (7, None, None, "x", 1.0), (None, 1, 1, "x", 1.0), (8, 1, 0, "x", 1.0), (999, 1, 1, "x", 1.0)], LABELS)
    model = module.train(frame, some, label)
    rows = module.score(frame, model).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1  # null and empty texts are the same
    empty = spark.createDataFrame([], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert module.score(empty, module.train(empty, none, label)).count() == 0
    assert len({r.score for r in module.score(frame, module.train(frame, none, label)).collect()}) == 1


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert (0, 1) in [tuple(sorted(p)) for p in model.pairs]
    assert auc(model.score(x[3000:]), y[3000:]) > 0.9


def test_features_do_not_depend_on_the_batch():
    texts = [t or "" for _, t, _ in edge_rows()]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    together = quality_gam.features(np.frombuffer(b"".join(raw), np.uint8), offsets)
    alone = np.concatenate([quality_gam.features(np.frombuffer(r, np.uint8), np.array([0, len(r)])) for r in raw])
    assert np.allclose(together, alone)


def test_network_gradients():
    rng = np.random.default_rng(2)
    texts = ["one two three four", "two five", "", "six one seven"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    h, bucket, bounds, number, first = toxicity.word_inputs(data, offsets)
    net = toxicity._blank(np.sort(h), rng)
    for name in ("into", "across", "bias", "attend", "out", "out_bias"):
        setattr(net, name, rng.normal(0, 0.5, getattr(net, name).shape))
    owner, start, length = toxicity.cut(first)
    steps = toxicity.step_numbers(number, start, length)
    inputs = net.vectors(h, bucket, bounds).astype(float) + rng.normal(0, 0.1, (len(h) + 1, toxicity.EMBEDDING))
    g = rng.normal(size=len(owner))
    loss = lambda x: float(net.run(x, steps, length) @ g)
    net.run(inputs, steps, length, keep=True)
    grads, d_inputs = net.back(g)
    for weight, grad in zip((net.into, net.across, net.bias, net.attend, net.out), grads, strict=False):
        at = tuple(rng.integers(0, s) for s in weight.shape)
        old = weight[at]
        weight[at] = old + 1e-3
        up = loss(inputs)
        weight[at] = old - 1e-3
        down = loss(inputs)
        weight[at] = old
        assert abs((up - down) / 2e-3 - grad[at]) < 2e-3 * max(1, abs(grad[at]))
    bumped = inputs.copy()
    bumped[0, 3] += 1e-3
    assert abs((loss(bumped) - loss(inputs)) / 1e-3 - d_inputs[0, 3]) < 1e-2


def test_toxicity_finds_words_and_overlapping_windows():
    texts, y = [], []
    for i in range(1200):
        w = prose(i, 90).split()
        if i % 4 == 0:
            for k in range(3):
                w[(i * 7 + 23 * k) % 90] = ["scoundrel", "nitwit", "villain"][(i // 4 + k) % 3]
        texts.append(" ".join(w))
        y.append(float(i % 4 == 0))
    model = toxicity.fit(texts[:1000], np.array(y[:1000]), np.arange(1000))
    raw = [t.encode() for t in texts[1000:]]
    s = model.score(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    assert auc(s, np.array(y[1000:])) > 0.95
    owner, start, length = toxicity.cut(np.array([0, 90, 90, 95]))
    assert (np.diff(start[owner == 0]) <= toxicity.STRIDE).all() and start[owner == 0][-1] + 32 == 90
    assert length[owner == 1].tolist() == [0] and length[owner == 2].tolist() == [5]


def test_sample_keeps_the_rare_class(spark):
    n, most = 3000, 200
    frame = docs_frame(spark, [(i, f"vile insult number {i}" if i % 300 == 7 else f"{prose(i, 12)}", "en") for i in range(n)])
    some = spark.createDataFrame([(i, int(i % 300 == 7), int(i % 300 == 7), None, None) for i in range(n)], LABELS)
    usable = some.filter(~held_out("doc_id"))
    rare, others = usable.filter("toxic = 1").count(), usable.filter("toxic = 0").count()
    rows, lacking = training_rows(frame, some, "toxic", most)
    y = np.array([r.y for r in rows.collect()])
    assert rare > 4 and (y == 1).sum() == rare and len(y) == most
    assert np.isclose(lacking, np.log(rare / others) - np.log(rare / (most - rare)))
    assert training_rows(frame, some, "toxic", n)[1] == 0 and training_rows(frame, some, "toxic", n)[0].count() == rare + others
    mean = np.mean([r.score for r in quality_gam.score(frame, quality_gam.train(frame, some, most_rows=most)).collect()])
    assert mean < 0.02  # the true share is a third of a hundredth, the sample's more than three


def test_a_repeated_id_counts_once(spark):
    """One id on a third of all rows, with equal and other texts: still one row of the sample, and the same one however rows are dealt."""
    rows = [(i, f"text {i}", "en" if i % 3 else "de") for i in range(600)] + [(1, f"again {i % 5}", "en") for i in range(300)]
    frame = docs_frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int")
    sample = training_rows(frame, labels, "toxic", 400)[0]
    assert sample.count() == 400
    assert sample.exceptAll(training_rows(frame.repartition(7), labels, "toxic", 400)[0]).count() == 0
    everything = training_rows(frame, labels, "toxic", 10_000)[0].collect()
    assert len(everything) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(600))


def test_language_sample_of_a_common_language(spark, monkeypatch):
    """The rows taken of a language that most rows have are those with the smallest hashes, found without sorting them all."""
    rows = [(i, f"wort {i} und text" if i % 10 == 0 else f"word {i} and text", "de" if i % 10 == 0 else "en") for i in range(3000)]
    rows += [(5, "repeated row", "en")] * 1500
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda w, y, languages: seen.append((w, y, languages)))
    language_id.train(docs_frame(spark, rows), most_rows=100)
    w, y, languages = seen[0]
    assert languages == ["de", "en"] and np.bincount(y).tolist() == [50, 50]
    assert len(np.unique(w, axis=0)) == 100
