import corpus_pipeline
from usagelens.llm import queries

from .brute import contamination, prose, words

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark, tmp_dir):
    """Each stage against plain Python on its own input, over the small documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF).write.parquet(f"{tmp_dir}/{name}")
        after = spark.read.parquet(f"{tmp_dir}/{name}")
        if name != "packing":
            assert after.columns == corpus_pipeline.COLUMNS
        was, now = {r.doc_id: r for r in before.collect()}, after.collect()
        left = {r.doc_id for r in now}
        if name == "quality":
            assert len(bad & left) <= 0.1 * len(bad) and len(left) >= 0.8 * len(was)
        elif name == "near_duplicates":
            shingles = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, r in was.items() if (w := words(r.text))}
            holders = {}
            for i, s in shingles.items():
                for g in s:
                    holders.setdefault(g, []).append(i)
            partners = {i: {j for g in shingles.get(i, ()) for j in holders[g] if j != i} for i in was}
            alike = lambda i, j: 5 * len(shingles[i] & shingles[j]) >= 4 * len(shingles[i] | shingles[j])  # noqa: E731, B023
            linked = {i: {j for j in p if alike(i, j)} for i, p in partners.items()}
            assert not any(linked[i] & left for i in left)  # no two of a group stay
            assert all(min(linked[i]) < i or any(linked[j] for j in linked[i]) for i in set(was) - left)
            assert all(i in left for i in was if not linked[i])
        elif name == "decontamination":
            hit = contamination([(i, r.text) for i, r in was.items()], items)
            assert left == {i for i, (_, n, _) in zip(was, hit, strict=True) if n == 0}
        elif name == "secrets":
            from .test_secret_scan import brute

            assert len(now) == len(was)
            for r in now:
                if brute(was[r.doc_id].text):
                    assert r.text != was[r.doc_id].text and r.n_chars == len(r.text)
                else:
                    assert r.text == was[r.doc_id].text
        else:
            assert left == set(was)
        before = after


def test_empty_documents(spark, tmp_dir):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, prose(1))], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0


def test_every_operator_is_registered():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
