"""Churn: feature matrix, split, scaling, balancing, three classifiers, scoring.

Only small things reach the driver: per-feature means / deviations, class
counts and the three models' metrics.  The scaler is a pipeline stage, so the
saved ``PipelineModel`` carries scaler and classifier together.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.columns import matching
from usagelens.operators.cuts import borders
from usagelens.operators.select import flag_first_n
from usagelens.operators.smote import smote
from usagelens.session import checkpointed, stored

LABEL = "churn_status"
#: Names of the platform counts in a user table.
PLATFORM_COLUMN = r"^platform_.*_count$"


def churn_feature_columns(platforms: list[str]) -> list[str]:
    """Model inputs in training order: usage features, recency, platform counts."""
    return schemas.USER_FEATURE_BASE + ["days_since_last_login"] + schemas.platform_columns(platforms)


def found_platforms(users: DataFrame) -> list[str]:
    """Platforms of a user table, from the names of its count columns, in column order."""
    return [c.removeprefix("platform_").removesuffix("_count") for c in matching(users, PLATFORM_COLUMN)]


def feature_matrix(users: DataFrame, platforms: list[str] | None = None) -> DataFrame:
    """user_id, numeric inputs (missing -> 0, as doubles) and the label.

    Without ``platforms`` the platform counts are the columns whose names say so."""
    cols = churn_feature_columns(found_platforms(users) if platforms is None else platforms)
    out = users.select("user_id", *[F.col(c).cast("double").alias(c) for c in cols], F.col(LABEL))
    return out.na.fill(0.0, subset=cols)


# ---- split ---------------------------------------------------------------------


def stratified_split(
    df: DataFrame, label: str = LABEL, test_size: float = schemas.TEST_SIZE, seed: int = schemas.RANDOM_STATE
) -> DataFrame:
    """Add ``is_test``: per class, the ``ceil(test_size * n_class)`` rows first in
    md5(user_id || seed) order.  Exact and repeatable, without sorting the
    table: a hash histogram finds each class's cut (see ``operators.select``)."""
    key = F.md5(F.concat(F.col("user_id").cast("string"), F.lit(str(seed))))
    n_test = F.ceil(F.lit(test_size) * F.col("__size"))
    return flag_first_n(df, label, key, n_test, "is_test", "user_id")


def class_counts(df: DataFrame, label: str = LABEL) -> dict:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def imbalance_report(train: DataFrame, label: str = LABEL, threshold: float = schemas.IMBALANCE_RATIO) -> DataFrame:
    """One row: class counts, count0 / count1 and whether oversampling applies.
    The test looks in one direction only (class 0 much larger than class 1)."""
    agg = train.agg(
        F.count_if(F.col(label) == 0).alias("class_0"),
        F.count_if(F.col(label) == 1).alias("class_1"),
    )
    ratio = F.try_divide(F.col("class_0").cast("double"), F.col("class_1").cast("double"))
    return agg.withColumn("ratio", ratio).withColumn("apply_smote", F.coalesce(F.col("ratio") > threshold, F.lit(False)))


# ---- scaling ---------------------------------------------------------------------


def _num(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def fit_scaler(train: DataFrame, cols: list[str], suffix: str = "_scaled") -> SQLTransformer:
    """Standardise with the training rows' mean and *population* deviation;
    a constant column maps to 0.  Returned as a saveable pipeline stage."""
    stats = train.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    exprs = []
    for i, c in enumerate(cols):
        mean, std = stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 0.0
        if std == 0.0 or math.isnan(std):
            exprs.append(f"CAST(0.0 AS DOUBLE) AS `{c}{suffix}`")
        else:
            exprs.append(f"(CAST(`{c}` AS DOUBLE) - {_num(mean)}) / {_num(std)} AS `{c}{suffix}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


# ---- models ------------------------------------------------------------------------


#: Share of the rows that a rare class may fill where a caller bounds the fitted rows (no query does).
RARE_SHARE = 0.1
#: Rows of a partition of the fitted table, about: up to ``FEW_PARTITIONS`` of them, and where that would make more.
FIT_PARTITION_ROWS = 32_768
FEW_PARTITIONS = 4
FULL_PARTITION_ROWS = 81_920
#: Depth of the forest's trees.
FOREST_DEPTH = 30
#: Bins of a feature, between which a tree may split (MLlib's default).
TREE_BINS = 32


def bounded_sample(train: DataFrame, counts: dict, most: int, seed: int) -> tuple[DataFrame, dict]:
    """At most ``most`` rows of ``train`` (all, if there are no more) and how many of each class (0, 1) they hold.

    A class takes its share of the rows, but the rarer one at least ``RARE_SHARE`` of them or all it has: the
    first rows in a hash order of the user, an exact number of each class, found without sorting the table."""
    total = sum(counts.values())
    if total <= most:
        return train, counts
    rare = min(counts, key=lambda c: (counts[c], c))
    taken = {rare: min(counts[rare], max(int(most * counts[rare] / total), int(most * RARE_SHARE)))}
    taken[1 - rare] = min(counts[1 - rare], most - taken[rare])
    order = F.md5(F.concat(F.col("user_id").cast("string"), F.lit(f":fit:{seed}")))
    wanted = F.when(F.col(LABEL) == rare, F.lit(taken[rare])).otherwise(F.lit(taken[1 - rare]))
    return flag_first_n(train, LABEL, order, wanted, "__fit", "user_id").where("__fit").drop("__fit"), taken


def fit_table(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows in partitions by the user's hash, sorted by user.

    Boosting, the forest and the regression read the rows some hundred times, and each time a task costs more
    than the few rows it may hold: the partitions come from the rows, not from the shuffles that made them.
    The three fits run side by side, and boosting, the longest, waits in each of its some 300 jobs for free cores:
    few partitions leave it some, and the regression adds up four or five without a stage between.
    The order is the same on every cluster, and so are the draws of the fits."""
    few = min(math.ceil(n / FIT_PARTITION_ROWS), FEW_PARTITIONS)
    return rows.repartition(max(few, math.ceil(n / FULL_PARTITION_ROWS), 1), "user_id").sortWithinPartitions("user_id")


def fit_weights(counts: dict, taken: dict, balanced: bool) -> Column:
    """Weight of a fitted row, so that the sample weighs what all training rows (and, if ``balanced``, as many
    synthetic ones as make the classes equal) would."""
    real = F.when(F.col(LABEL) == 0, F.lit(counts[0] / taken[0])).otherwise(F.lit(counts[1] / taken[1]))
    if not balanced or taken[0] == taken[1]:
        return real
    return F.when(F.col("is_synthetic"), F.lit((counts[0] - counts[1]) / (taken[0] - taken[1]))).otherwise(real)


def fit_bins(rows: DataFrame, cols: list[str]) -> list:
    """Pipeline stages that put each feature's bin, of ``TREE_BINS`` with borders from all rows, into the vector ``bins``."""
    cuts = borders(rows, cols, "weight", TREE_BINS)
    named = [f"{c}_bin" for c in cols]
    inner = [c or [0.0] for c in cuts]  # a constant feature: any border, all rows on one side
    binned = Bucketizer(splitsArray=[[-math.inf, *c, math.inf] for c in inner], inputCols=cols, outputCols=named)
    return [binned, VectorAssembler(inputCols=named, outputCol="bins")]


def all_rows_bins(n: int) -> int:
    """``maxBins`` with which MLlib looks at all of ``n`` rows, not at a sample of maxBins ** 2, for where to split."""
    return max(TREE_BINS, min(math.isqrt(max(n - 1, 0)) + 1, 46_340))  # its square is a 32-bit number


def classifiers(n_train: float, seed: int = schemas.RANDOM_STATE, max_depth: int = FOREST_DEPTH, min_leaf_rows: int = 1, n_rows: int = 0) -> dict:
    """Three classifiers with the usual library defaults spelled out:
    L2 logistic regression with C = 1 (regParam = 1 / (C * n)), a 100-tree forest
    with sqrt(p) features per split grown deep, and 100 boosting rounds of depth-3
    trees at rate 0.1.  The trees are for features in bins (``fit_bins``) of ``n_rows`` rows."""
    max_bins = all_rows_bins(n_rows)
    return {
        "Logistic Regression": LogisticRegression(
            regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False, maxIter=100
        ),
        "Random Forest Classifier": RandomForestClassifier(
            numTrees=100, featureSubsetStrategy="sqrt", maxDepth=max_depth, minInstancesPerNode=min_leaf_rows, seed=seed,
            featuresCol="bins", maxBins=max_bins,
            cacheNodeIds=True,  # rows keep their node of each tree instead of walking down from the root at every level
        ),
        "Gradient Boosting Classifier": GBTClassifier(maxIter=100, stepSize=0.1, maxDepth=3, seed=seed, featuresCol="bins", maxBins=max_bins),
    }


def classification_report(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Per-class precision / recall / F1 / support, plus accuracy, macro and
    weighted averages, from the 2x2 confusion counts (one aggregate)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = pred.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp1"),
        F.count_if((y == 0) & (p == 1)).alias("fp1"),
        F.count_if((y == 1) & (p == 0)).alias("fn1"),
        F.count_if((y == 0) & (p == 0)).alias("tp0"),
    )

    def ratio(num: F.Column, den: F.Column) -> F.Column:
        return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))

    tp1, fp1, fn1, tp0 = (F.col(x) for x in ("tp1", "fp1", "fn1", "tp0"))
    fp0, fn0 = fn1, fp1
    s1, s0 = tp1 + fn1, tp0 + fp1
    rows = {
        "0": (ratio(tp0, tp0 + fp0), ratio(tp0, tp0 + fn0), ratio(2 * tp0, 2 * tp0 + fp0 + fn0), s0),
        "1": (ratio(tp1, tp1 + fp1), ratio(tp1, tp1 + fn1), ratio(2 * tp1, 2 * tp1 + fp1 + fn1), s1),
    }
    per = c.select(
        *[
            F.struct(
                F.lit(k).alias("class_label"),
                v[0].alias("precision"),
                v[1].alias("recall"),
                v[2].alias("f1_score"),
                v[3].cast("bigint").alias("support"),
            ).alias(f"r{k}")
            for k, v in rows.items()
        ],
        (s0 + s1).alias("__n"),
        (tp0 + tp1).alias("__correct"),
    )
    r0, r1, n = F.col("r0"), F.col("r1"), F.col("__n")

    def avg2(field: str) -> F.Column:
        return (r0[field] + r1[field]) / F.lit(2.0)

    def wavg(field: str) -> F.Column:
        return ratio(r0[field] * r0["support"] + r1[field] * r1["support"], n).alias(field)

    acc = ratio(F.col("__correct"), n)
    summary = F.array(
        r0,
        r1,
        F.struct(F.lit("accuracy").alias("class_label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"), n.cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("class_label"), avg2("precision").alias("precision"),
                 avg2("recall").alias("recall"), avg2("f1_score").alias("f1_score"), n.cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("class_label"), wavg("precision"), wavg("recall"), wavg("f1_score"),
                 n.cast("bigint").alias("support")),
    )
    return per.select(F.inline(summary))


@dataclass
class ChurnTraining:
    model: PipelineModel
    best_name: str
    comparison: DataFrame  # model, f1_score, precision, recall, accuracy, is_best
    feature_cols: list[str]
    models: dict  # name -> PipelineModel


def train_churn_models(
    users: DataFrame,
    platforms: list[str],
    seed: int = schemas.RANDOM_STATE,
    test_size: float = schemas.TEST_SIZE,
    smote_k: int = schemas.SMOTE_K,
    max_fit_rows: int | None = None,
    max_depth: int = FOREST_DEPTH,
    min_leaf_rows: int = 1,
) -> ChurnTraining:
    """Split, scale on training rows, oversample if class 0 outweighs class 1 by
    more than 1.5, fit three models, keep the best by class-1 F1 on the test rows
    (strictly better wins; the first model wins ties).

    All training rows are fitted on and tell where trees may split, all test rows are
    judged and all users scored.  Only a
    caller that names ``max_fit_rows`` gets, of more rows, models of a sample by class
    (``bounded_sample``), weighted to stand for all, with the scaler and the class ratio
    of all rows.  ``max_depth`` and ``min_leaf_rows`` bound the forest's trees."""
    spark = users.sparkSession
    cols = churn_feature_columns(platforms)
    data = stratified_split(feature_matrix(users, platforms), LABEL, test_size, seed)  # over stored rows
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    counts = class_counts(train)
    if len(counts) < 2 or 0 in counts.values():
        raise ValueError(f"training rows hold a single class {counts}; choose another churn threshold")
    scaler = fit_scaler(train, cols)
    scaled_cols = [f"{c}_scaled" for c in cols]
    fitted, taken = (train, counts) if max_fit_rows is None else bounded_sample(train, counts, max_fit_rows, seed)
    train_scaled = stored(scaler.transform(fitted), "churn-fitted")  # read several times by SMOTE
    oversample = counts[0] / counts[1] > schemas.IMBALANCE_RATIO
    if oversample:
        balanced = smote(train_scaled, "user_id", scaled_cols, LABEL, 1, smote_k, seed)
    else:
        balanced = train_scaled.select("user_id", *scaled_cols, LABEL)
    balanced = balanced.withColumn("weight", fit_weights(counts, taken, oversample))
    assembler = VectorAssembler(inputCols=scaled_cols, outputCol="features")
    n_rows = 2 * max(taken.values()) if oversample else sum(taken.values())
    fit_rows = fit_table(balanced.withColumn("label", F.col(LABEL).cast("double")), n_rows)
    # Some 400 jobs read these rows: without the steps of SMOTE behind them, which every task would unpack anew.
    fit_rows = checkpointed(fit_rows.select("label", *scaled_cols, "weight"))
    features = [assembler, *fit_bins(fit_rows, scaled_cols)]
    for stage in features:
        fit_rows = stage.transform(fit_rows)
    fit_rows = fit_rows.select("label", "features", "bins", "weight").persist()
    n_fit = fit_rows.agg(F.sum("weight")).first()[0]
    weighted = taken != counts
    test_scaled = scaler.transform(test)

    def evaluate(item):
        name, est = item
        est = est.setLabelCol("label")
        fitted = (est.setWeightCol("weight") if weighted else est).fit(fit_rows)
        pred = PipelineModel(stages=[*features, fitted]).transform(test_scaled)
        rep = {r["class_label"]: r for r in classification_report(pred).collect()}  # five small rows
        return name, fitted, rep

    # The three fits are independent: run them as concurrent Spark jobs.
    with ThreadPoolExecutor(max_workers=3) as pool:
        fitted_all = list(pool.map(evaluate, classifiers(n_fit, seed, max_depth, min_leaf_rows, n_rows).items()))
    results, best = [], None
    for name, fitted, rep in fitted_all:  # model order decides ties: first wins
        f1 = rep["1"]["f1_score"]
        results.append((name, f1, rep["1"]["precision"], rep["1"]["recall"], rep["accuracy"]["f1_score"]))
        if best is None or f1 > best[1]:
            best = (name, f1, fitted)
    fit_rows.unpersist()
    comparison = spark.createDataFrame(
        [(n, f, p, r, a, n == best[0]) for n, f, p, r, a in results],
        "model string, f1_score double, precision double, recall double, accuracy double, is_best boolean",
    )
    models = {name: PipelineModel(stages=[scaler, *features, fitted]) for name, fitted, _ in fitted_all}
    return ChurnTraining(models[best[0]], best[0], comparison, cols, models)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, users: DataFrame, platforms: list[str]) -> DataFrame:
    """User rows (types kept) + churn_probability (class 1) + predicted_churn (0/1).
    The pipeline's scaler reads the raw columns; missing inputs count as 0."""
    x = users
    for c in churn_feature_columns(platforms):
        if c not in x.columns:
            x = x.withColumn(c, F.lit(0))
    x = x.na.fill(0, subset=churn_feature_columns(platforms))
    scored = model.transform(x)
    return scored.select(
        *users.columns,
        vector_to_array("probability")[1].alias("churn_probability"),
        F.col("prediction").cast("int").alias("predicted_churn"),
    )
