import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from usagelens.plans import churn, segments
from usagelens.session import scratch_path


def test_stratified_split_counts(spark):
    df = spark.createDataFrame([(f"u{i}", 1 if i % 5 == 0 else 0) for i in range(203)], "user_id string, churn_status int")
    out = churn.stratified_split(df)
    got = {(r.churn_status, r.is_test): r["count"] for r in out.groupBy("churn_status", "is_test").count().collect()}
    n1 = sum(1 for i in range(203) if i % 5 == 0)
    n0 = 203 - n1
    assert got[(1, True)] == math.ceil(0.2 * n1) and got[(0, True)] == math.ceil(0.2 * n0)
    assert got[(1, False)] + got[(1, True)] == n1
    assert out.select("user_id", "is_test").exceptAll(churn.stratified_split(df).select("user_id", "is_test")).count() == 0


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = churn.fit_scaler(df, ["a", "b"]).transform(df).orderBy("a").collect()
    sd = np.std([1.0, 2.0, 3.0])  # population
    assert [r.a_scaled for r in out] == pytest.approx([-1 / sd, 0.0, 1 / sd])
    assert [r.b_scaled for r in out] == [0.0, 0.0, 0.0]


def test_classification_report_arithmetic(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "churn_status int, prediction int")
    rep = {r.class_label: r for r in churn.classification_report(df).collect()}
    assert rep["1"].precision == 3 / 5 and rep["1"].recall == 3 / 4 and rep["1"].support == 4
    assert rep["0"].precision == 4 / 5 and rep["0"].recall == 4 / 6 and rep["0"].support == 6
    assert rep["1"].f1_score == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    assert rep["accuracy"].f1_score == 0.7 and rep["accuracy"].support == 10
    assert rep["macro avg"].recall == pytest.approx((0.75 + 4 / 6) / 2)


def test_one_class_raises(spark):
    from usagelens.operators import users
    from usagelens.plans.q_etl import facts

    u = users.churn_users(facts(spark, "/root/testdata/sf0.001", "events"), ["click", "error", "purchase", "signup", "view"], 30)
    with pytest.raises(ValueError):
        churn.train_churn_models(u, ["click", "error", "purchase", "signup", "view"])


def test_name_clusters_greedy():
    rows = [
        {"cluster": 0, "total_events": 5, "login_frequency": 3, "unique_features_used": 9},
        {"cluster": 1, "total_events": 50, "login_frequency": 20, "unique_features_used": 4},
        {"cluster": 2, "total_events": 6, "login_frequency": 1, "unique_features_used": 8},
        {"cluster": 3, "total_events": 7, "login_frequency": 4, "unique_features_used": 2},
    ]
    assert segments.name_clusters(rows) == {
        1: "Power Users",
        2: "At-Risk Users",
        0: "Feature Explorers",
        3: "Regular Users",
    }


def test_train_save_load_score_roundtrip(spark):
    """Small end-to-end run: four segment names, every user once, identical
    probabilities after save / load."""
    from usagelens.operators import users
    from usagelens.plans.q_etl import facts

    fx = facts(spark, "/root/testdata/sf0.001", "orders")
    u = users.churn_users(fx, ["F", "O", "P"], 365)
    trained = churn.train_churn_models(u, ["F", "O", "P"])
    assert trained.comparison.count() == 3 and trained.comparison.where("is_best").count() == 1
    path = scratch_path(spark, "test-model")
    churn.save_model(trained.model, path)
    a = churn.score(trained.model, u.drop("churn_status"), ["F", "O", "P"])
    b = churn.score(churn.load_model(path), u.drop("churn_status"), ["F", "O", "P"])
    assert a.exceptAll(b).count() == 0
    assert a.where((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0

    seg = segments.segment_users(users.user_features(fx, ["F", "O", "P"]), n_init=2)
    names = {r.Segment for r in seg.assignments.select("Segment").distinct().collect()}
    assert names <= {"Power Users", "Regular Users", "At-Risk Users", "Feature Explorers"}
    assert seg.assignments.count() == seg.assignments.select("user_id").distinct().count() == u.count()


def test_flag_first_n_matches_sorting(spark):
    from usagelens.operators.select import flag_first_n

    rows = [(f"u{i}", i % 3) for i in range(5000)]
    df = spark.createDataFrame(rows, "user_id string, g int")
    key = F.md5(F.col("user_id"))
    out = flag_first_n(df, "g", key, F.ceil(F.lit(0.37) * F.col("__size")), "pick", "user_id")
    got = {r.user_id for r in out.where("pick").collect()}
    import hashlib

    expect = set()
    for g in range(3):
        members = sorted((hashlib.md5(u.encode()).hexdigest(), u) for u, gg in rows if gg == g)
        expect |= {u for _, u in members[: math.ceil(0.37 * len(members))]}
    assert got == expect
    none = flag_first_n(df, "g", key, F.lit(0), "pick", "user_id").where("pick").count()
    allr = flag_first_n(df, "g", key, F.lit(10**6), "pick", "user_id").where("pick").count()
    assert none == 0 and allr == 5000


def test_first_n_is_told_without_a_join_of_rows(spark):
    """The flag compares a row with the last one that is in: no sort or shuffle of the table, no Python workers."""
    from usagelens.operators.select import flag_first_n

    df = spark.createDataFrame([(f"u{i}", i % 2) for i in range(3000)], "user_id string, g int")
    # the whole group in two buckets: both boundaries hold many rows, of which some have equal keys
    key = F.concat(F.lit("ab0"), F.substring(F.md5("user_id"), 1, 2))
    out = flag_first_n(df, "g", key, F.lit(700), "pick", "user_id").orderBy("user_id")
    plan = flag_first_n(df, "g", key, F.lit(700), "pick", "user_id")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and plan.count("Join") == 1 and "Window" not in plan
    ranked = df.withColumn("key", key).orderBy("g", "key", "user_id").collect()
    for g in (0, 1):
        expect = {r.user_id for r in [r for r in ranked if r.g == g][:700]}
        assert {r.user_id for r in out.where(f"pick AND g = {g}").collect()} == expect


def test_nothing_stays_persisted(spark):
    from usagelens.plans import registry

    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for key in ("stratified_split", "segment_profiles"):
        registry.queries()[key](spark, "/root/testdata/sf0.001").count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def _rare(spark, n=30_000, every=250):
    """Rows of which one in ``every`` churns, told by two of the features."""
    cols = churn.churn_feature_columns(["web"])
    data = spark.range(n).select(F.concat(F.lit("u"), "id").alias("user_id"), (F.col("id") % every == 0).cast("int").alias("churn_status"), "id")
    noise = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)).cast("double") / 1000
    told = {cols[0]: noise(0) + 3 * F.col("churn_status"), cols[1]: noise(1) - 2 * F.col("churn_status")}
    return data.select("user_id", *[told.get(c, noise(i)).alias(c) for i, c in enumerate(cols)], "churn_status"), cols


def test_a_rare_class_trains_on_a_bounded_sample(spark):
    data, cols = _rare(spark)
    trained = churn.train_churn_models(data, ["web"], max_fit_rows=2_000, max_depth=5)
    best = trained.comparison.where("is_best").first()
    assert best.f1_score > 0.9
    # the scaler knows all training rows, not the sample
    train = churn.stratified_split(data).where("NOT is_test")
    mean, deviation = train.agg(F.avg(cols[0]), F.stddev_pop(cols[0])).first()
    assert f"'{mean!r}'" in trained.model.stages[0].getStatement() and f"'{deviation!r}'" in trained.model.stages[0].getStatement()


def test_bounded_sample_and_its_weights(spark):
    data, _ = _rare(spark)
    counts = churn.class_counts(data)
    assert counts == {0: 29_880, 1: 120}
    sample, taken = churn.bounded_sample(data, counts, 2_000, 42)
    assert taken == {1: 120, 0: 1_880} == churn.class_counts(sample)
    again, _ = churn.bounded_sample(data.repartition(7), counts, 2_000, 42)
    assert sample.exceptAll(again).count() == 0
    balanced = sample.select("user_id", "churn_status", F.lit(False).alias("is_synthetic")).unionByName(
        spark.range(1_880 - 120).select(F.col("id").cast("string").alias("user_id"), F.lit(1).alias("churn_status"), F.lit(True).alias("is_synthetic"))
    )
    weighed = balanced.withColumn("w", churn.fit_weights(counts, taken, True)).groupBy("churn_status").agg(F.sum("w").alias("w"))
    assert {r.churn_status: r.w for r in weighed.collect()} == pytest.approx({0: 29_880, 1: 29_880})
    assert churn.bounded_sample(data, counts, 10**6, 42) == (data, counts)
    common, taken = churn.bounded_sample(data, {0: 29_880, 1: 120}, 200, 42)  # less room than the rare class has
    assert taken == {1: 20, 0: 180} and common.count() == 200


def test_fit_rows_are_bounded(spark):
    from usagelens.plans import churn

    rows = [(f"u{i}", float(i % 7), float(i % 11), i % 3) for i in range(600)]
    cols = churn.churn_feature_columns(["web"])
    data = spark.createDataFrame([(u, *([a, b] + [1.0] * len(cols))[: len(cols)], int(c == 0)) for u, a, b, c in rows], ["user_id", *cols, "churn_status"])
    trained = churn.train_churn_models(data, ["web"], max_fit_rows=200, max_depth=5)
    assert trained.comparison.count() == 3 and set(trained.models) == {r.model for r in trained.comparison.collect()}


def test_fitted_rows_have_partitions_by_their_number(spark):
    """However many partitions and in what order rows come: the same few partitions, so the same draws of the fits."""
    ids = spark.range(70_000).select(F.concat(F.lit("u"), "id").alias("user_id"))
    one, other = (churn.fit_table(ids.repartition(n), 70_000) for n in (50, 3))
    assert one.rdd.getNumPartitions() == other.rdd.getNumPartitions() == 3
    assert one.rdd.glom().map(lambda p: [r.user_id for r in p[:9]]).collect() == other.rdd.glom().map(lambda p: [r.user_id for r in p[:9]]).collect()


def test_a_bounded_fit_has_few_partitions(spark):
    """Boosting reads the rows some 300 times: 10 partitions of 313,000 rows made three fits wait for each other."""
    ids = spark.range(100).select(F.concat(F.lit("u"), "id").alias("user_id"))
    for n, partitions in ((100, 1), (113_000, 4), (313_000, 4), (2 * 180_000, 5), (2_000_000, 25)):
        assert churn.fit_table(ids, n).rdd.getNumPartitions() == partitions


def test_training_and_scoring_read_a_stored_user_table(spark, monkeypatch):
    from usagelens.plans import q_churn

    read = []

    def stop(users, platforms):
        read.extend(users.inputFiles())
        raise InterruptedError

    monkeypatch.setattr(churn, "train_churn_models", stop)
    for query in (q_churn.q_churn_score, q_churn.q_churn_models_check):
        with pytest.raises(InterruptedError):
            query(spark, "/root/testdata/sf0.001")
    assert read and all("usagelens-churn-users" in f for f in read)


def test_fits_read_rows_without_the_steps_that_made_them(spark, monkeypatch):
    """Some 400 jobs read the fitted rows: their tasks carried all of SMOTE's steps, which took longer to unpack than to run."""
    lineage = []

    class Stopped:
        setFeaturesCol = setLabelCol = setWeightCol = lambda self, _: self

        def fit(self, rows):
            lineage.append(rows._jdf.queryExecution().toRdd().toDebugString())
            raise InterruptedError

    monkeypatch.setattr(churn, "classifiers", lambda *a: {"none": Stopped()})
    data, _ = _rare(spark, n=1_000, every=10)
    try:
        with pytest.raises(InterruptedError):
            churn.train_churn_models(data, ["web"])
    finally:
        spark.catalog.clearCache()
    assert "ReliableCheckpointRDD" in lineage[0] and "Shuffled" not in lineage[0]


class _Stopped:
    """A classifier that notes the rows it is given, by label, and stops."""

    setFeaturesCol = setLabelCol = setWeightCol = lambda self, _: self

    def __init__(self, seen):
        self.seen = seen

    def fit(self, rows):
        self.seen.extend(tuple(r) for r in rows.groupBy("label").agg(F.count(F.lit(1)), F.sum("weight")).orderBy("label").collect())
        raise InterruptedError


def test_all_training_rows_are_fitted(spark, monkeypatch):
    """Fits once took 200,000 training rows at most."""
    seen = []
    monkeypatch.setattr(churn, "classifiers", lambda *a: {"none": _Stopped(seen)})
    data, _ = _rare(spark, n=300_000, every=2)
    try:
        with pytest.raises(InterruptedError):
            churn.train_churn_models(data, ["web"])
    finally:
        spark.catalog.clearCache()
    assert seen == [(0.0, 120_000, 120_000.0), (1.0, 120_000, 120_000.0)]


@pytest.mark.parametrize("query", ["churn_model_comparison", "churn_models_check", "churn_score", "churn_summary", "dim_users_loaded", "segment_engagement"])
def test_no_query_fits_a_sample(spark, monkeypatch, query):
    from usagelens.plans import q_churn, registry

    seen = []

    def sampled(*_):
        raise AssertionError("fits a sample")

    monkeypatch.setattr(churn, "classifiers", lambda *a: {"none": _Stopped(seen)})
    monkeypatch.setattr(churn, "bounded_sample", sampled)
    monkeypatch.setattr(segments, "segment_users", lambda users: SimpleNamespace(assignments=users))
    try:
        with pytest.raises(InterruptedError):
            registry.queries()[query](spark, "/root/testdata/sf0.001")
    finally:
        spark.catalog.clearCache()
    most = q_churn.split_rows(spark, "/root/testdata/sf0.001").where("NOT is_test AND churn_status = 0").count()
    assert seen == [(0.0, most, most), (1.0, most, most)]  # the rarer class filled up by SMOTE


def test_where_trees_split_comes_from_all_rows(spark, monkeypatch):
    """MLlib looked for the borders of its bins in about 10,000 rows, so none lay where half of all rows end."""
    real, n = churn.classifiers, 40_000
    monkeypatch.setattr(churn, "classifiers", lambda *a: {"Tree": real(*a)["Gradient Boosting Classifier"].setMaxIter(1).setMaxDepth(1)})
    cols = churn.churn_feature_columns(["web"])
    late = F.col("id") >= n // 2
    rows = spark.range(n).select(F.concat(F.lit("u"), "id").alias("user_id"), late.cast("int").alias("churn_status"), F.when(late, F.col("id") + n).otherwise(F.col("id")).alias("at"))
    data = rows.select("user_id", *[(F.col("at") if c == cols[2] else F.lit(1)).cast("double").alias(c) for c in cols], "churn_status")
    assert churn.train_churn_models(data, ["web"]).comparison.first().f1_score == 1.0


def test_trees_look_at_all_rows():
    for n, bins in ((0, 32), (1, 32), (1_024, 32), (1_025, 33), (1_127_520, 1_062), (10**10, 46_340)):
        assert churn.all_rows_bins(n) == bins and (bins**2 >= n or bins**2 < 2**31 < (bins + 1) ** 2)
