"""Registered queries: churn feature matrix, split, scaling, SMOTE, models, scoring.

All on the orders history with a 365-day threshold (the only supplied table
with both classes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.operators import users
from usagelens.operators.knn import DIST_DECIMALS, exact_knn
from usagelens.operators.smote import smote
from usagelens.plans import churn
from usagelens.plans.oracle_sql import churn_users_cte, facts_cte
from usagelens.plans.q_etl import facts
from usagelens.plans.registry import register
from usagelens.session import scratch_path, stored
from usagelens.sources import adapters

PLATS = adapters.ORDERS_PLATFORMS
DAYS = adapters.ORDERS_CHURN_DAYS
FEATS = churn.churn_feature_columns(PLATS)
ROUND = 9  # reported scaled values are rounded so engines agree


def churn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.churn_users(facts(spark, sf_dir, "orders"), PLATS, DAYS)


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.stratified_split(churn.feature_matrix(churn_table(spark, sf_dir), PLATS))


def scaled_train(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    train = split_rows(spark, sf_dir).where(~F.col("is_test"))
    scaler = churn.fit_scaler(train, FEATS)
    return scaler.transform(train), [f"{c}_scaled" for c in FEATS]


# ---- SQL twins --------------------------------------------------------------------

_BASE = f"""WITH {facts_cte('orders')}, {churn_users_cte('orders', DAYS)},
fm AS (SELECT user_id, {', '.join(f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in FEATS)}, churn_status FROM users),
sp AS (SELECT *, row_number() OVER (PARTITION BY churn_status ORDER BY md5(user_id || '42')) AS __r,
              count(*) OVER (PARTITION BY churn_status) AS __n FROM fm),
split AS (SELECT * EXCLUDE (__r, __n), __r <= ceil(CAST(0.2 AS DOUBLE) * __n) AS is_test FROM sp),
train AS (SELECT * FROM split WHERE NOT is_test),
stats AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in FEATS)} FROM train),
scaled AS (SELECT user_id, churn_status,
  {', '.join(f'CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END AS {c}' for c in FEATS)}
  FROM train, stats)"""

_DIST = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS)


@register("churn_feature_matrix", f"{_BASE} SELECT * FROM fm")
def q_churn_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platform counts are found by the pattern of their names."""
    return churn.feature_matrix(churn_table(spark, sf_dir))


@register("stratified_split", f"{_BASE} SELECT user_id, churn_status, is_test FROM split")
def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(spark, sf_dir).select("user_id", "churn_status", "is_test")


@register(
    "imbalance_ratio",
    f"""{_BASE}
SELECT CAST(count_if(churn_status = 0) AS BIGINT) AS class_0, CAST(count_if(churn_status = 1) AS BIGINT) AS class_1,
       CAST(count_if(churn_status = 0) AS DOUBLE) / CAST(count_if(churn_status = 1) AS DOUBLE) AS ratio,
       CAST(count_if(churn_status = 0) AS DOUBLE) / CAST(count_if(churn_status = 1) AS DOUBLE) > 1.5 AS apply_smote
FROM train""",
)
def q_imbalance_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.imbalance_report(split_rows(spark, sf_dir).where(~F.col("is_test")))


@register(
    "scaled_features",
    f"{_BASE} SELECT user_id, churn_status, {', '.join(f'round({c}, {ROUND}) AS {c}' for c in FEATS)} FROM scaled",
)
def q_scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cols = scaled_train(spark, sf_dir)
    return rows.select(
        "user_id", "churn_status", *[F.round(c, ROUND).alias(c.removesuffix("_scaled")) for c in cols]
    )


@register(
    "smote_neighbors",
    f"""{_BASE},
m AS (SELECT * FROM scaled WHERE churn_status = 1),
d AS (SELECT a.user_id, b.user_id AS neighbor_id, round({_DIST}, {DIST_DECIMALS}) AS dist
      FROM m a JOIN m b ON a.user_id <> b.user_id)
SELECT user_id, CAST(neighbor_rank AS INTEGER) AS neighbor_rank, neighbor_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY dist, neighbor_id) AS neighbor_rank FROM d)
WHERE neighbor_rank <= {schemas.SMOTE_K}""",
)
def q_smote_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 5 nearest minority neighbours of every minority training row
    (blocked k-NN; the SQL twin uses a plain self-join on the small fixture)."""
    rows, cols = scaled_train(spark, sf_dir)
    minority = rows.where(F.col("churn_status") == 1).select("user_id", *cols)
    return exact_knn(minority, "user_id", cols, schemas.SMOTE_K).select("user_id", "neighbor_rank", "neighbor_id")


def _hex(n: int, what: str) -> str:
    return f"CAST('0x' || substr(md5(g.user_id || ':' || g.j || ':{schemas.RANDOM_STATE}:{what}'), 1, {n}) AS BIGINT)"


@register(
    "smote_balanced",
    f"""{_BASE},
m AS (SELECT *, row_number() OVER (ORDER BY md5(user_id || '{schemas.RANDOM_STATE}'), user_id) AS place FROM scaled WHERE churn_status = 1),
d AS (SELECT a.user_id, b.user_id AS neighbor_id, round({_DIST}, {DIST_DECIMALS}) AS dist
      FROM m a JOIN m b ON a.user_id <> b.user_id),
nb AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY dist, neighbor_id) AS neighbor_rank FROM d),
c AS (SELECT count_if(churn_status = 1) AS n1, count_if(churn_status = 0) - count_if(churn_status = 1) AS need FROM scaled),
g AS (SELECT m.user_id, unnest(range(0, CAST(CASE WHEN place <= need % n1 THEN need // n1 + 1 ELSE need // n1 END AS BIGINT))) AS j FROM m, c)
SELECT user_id, {', '.join(f'round({f}, {ROUND}) AS {f}' for f in FEATS)}, churn_status, false AS is_synthetic FROM scaled
UNION ALL
SELECT g.user_id || '#s' || g.j, {', '.join(f"round(a.{f} + {_hex(13, 'gap')} / {float(16**13)} * (b.{f} - a.{f}), {ROUND})" for f in FEATS)}, 1, true
FROM g JOIN m a ON a.user_id = g.user_id
JOIN nb ON nb.user_id = g.user_id AND nb.neighbor_rank = {_hex(8, 'neighbour')} % {schemas.SMOTE_K} + 1
JOIN m b ON b.user_id = nb.neighbor_id""",
)
def q_smote_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cols = scaled_train(spark, sf_dir)
    out = smote(rows, "user_id", cols, "churn_status", 1, schemas.SMOTE_K, schemas.RANDOM_STATE)
    rounded = [F.round(c, ROUND).alias(c.removesuffix("_scaled")) for c in cols]
    return out.select("user_id", *rounded, "churn_status", "is_synthetic")


@register(
    "classification_report",
    f"""{_BASE},
p AS (SELECT churn_status AS y, CAST(days_since_last_login > 180 AS INTEGER) AS p FROM users),
c AS (SELECT count_if(y = 1 AND p = 1) AS tp1, count_if(y = 0 AND p = 1) AS fp1,
             count_if(y = 1 AND p = 0) AS fn1, count_if(y = 0 AND p = 0) AS tp0 FROM p),
r AS (SELECT
  CASE WHEN tp0 + fn1 > 0 THEN tp0::DOUBLE / (tp0 + fn1)::DOUBLE ELSE 0.0 END AS p0,
  CASE WHEN tp0 + fp1 > 0 THEN tp0::DOUBLE / (tp0 + fp1)::DOUBLE ELSE 0.0 END AS r0,
  CASE WHEN 2 * tp0 + fn1 + fp1 > 0 THEN (2 * tp0)::DOUBLE / (2 * tp0 + fn1 + fp1)::DOUBLE ELSE 0.0 END AS f0,
  CASE WHEN tp1 + fp1 > 0 THEN tp1::DOUBLE / (tp1 + fp1)::DOUBLE ELSE 0.0 END AS p1,
  CASE WHEN tp1 + fn1 > 0 THEN tp1::DOUBLE / (tp1 + fn1)::DOUBLE ELSE 0.0 END AS r1,
  CASE WHEN 2 * tp1 + fp1 + fn1 > 0 THEN (2 * tp1)::DOUBLE / (2 * tp1 + fp1 + fn1)::DOUBLE ELSE 0.0 END AS f1,
  tp0 + fp1 AS s0, tp1 + fn1 AS s1, tp0 + tp1 AS ok FROM c)
SELECT '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, CAST(s0 AS BIGINT) AS support FROM r
UNION ALL SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN s0 + s1 > 0 THEN ok::DOUBLE / (s0 + s1)::DOUBLE ELSE 0.0 END,
                 CAST(s0 + s1 AS BIGINT) FROM r
UNION ALL SELECT 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, CAST(s0 + s1 AS BIGINT) FROM r
UNION ALL SELECT 'weighted avg',
  CASE WHEN s0 + s1 > 0 THEN (p0 * s0 + p1 * s1) / (s0 + s1)::DOUBLE ELSE 0.0 END,
  CASE WHEN s0 + s1 > 0 THEN (r0 * s0 + r1 * s1) / (s0 + s1)::DOUBLE ELSE 0.0 END,
  CASE WHEN s0 + s1 > 0 THEN (f0 * s0 + f1 * s1) / (s0 + s1)::DOUBLE ELSE 0.0 END,
  CAST(s0 + s1 AS BIGINT) FROM r""",
)
def q_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report arithmetic on a fixed rule (idle more than 180 days -> churn) so it
    can be checked exactly; the models use the same function."""
    u = churn_table(spark, sf_dir)
    pred = u.withColumn("prediction", (F.col("days_since_last_login") > 180).cast("int"))
    return churn.classification_report(pred)


@register("churn_model_comparison")
def q_churn_model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.train_churn_models(churn_table(spark, sf_dir), PLATS).comparison


@register("churn_score")
def q_churn_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save the best pipeline (scaler + model), load it back, score every user."""
    u = stored(churn_table(spark, sf_dir), "churn-users")  # read for training and each scoring
    trained = churn.train_churn_models(u, PLATS)
    path = scratch_path(spark, "churn-model")
    churn.save_model(trained.model, path)
    return churn.score(churn.load_model(path), u.drop("churn_status"), PLATS)


_RULE = "total_events < (SELECT avg(total_events) FROM train)"


@register(
    "churn_models_check",
    f"""{_BASE},
r AS (SELECT churn_status AS y, {_RULE} AS p FROM split WHERE is_test),
c AS (SELECT count_if(y = 1 AND p) AS tp, count_if(y = 0 AND p) AS fp, count_if(y = 1 AND NOT p) AS fn FROM r)
SELECT what, CAST(CASE value WHEN -1 THEN (SELECT count(DISTINCT o_custkey) FROM orders) WHEN -2 THEN (SELECT count_if(is_test) FROM split)
                  WHEN -3 THEN (SELECT floor(1000000 * CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn)) FROM c) ELSE value END AS BIGINT) AS value
FROM (VALUES ('users', -1), ('changed_by_saving', 0), ('tested', -2), ('wrong_f1', 0), ('wrong_best', 0), ('rule_f1_millionths', -3),
             ('best_beats_rule', 1)) t(what, value)""",
)
def q_churn_models_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the models learn: every user is scored once and the same after saving and loading; each model's F1,
    computed anew from its scores of the test users, is the reported one, and the first of the highest is the one
    that was kept; and it is higher than the F1 of a plain rule (fewer events than the average training user)."""
    u = stored(churn_table(spark, sf_dir), "churn-users")  # read for training and each scoring
    trained = churn.train_churn_models(u, PLATS)
    path = scratch_path(spark, "churn-model")
    churn.save_model(trained.model, path)
    rows = u.drop("churn_status")
    kept = churn.score(trained.model, rows, PLATS).select("user_id", "churn_probability", "predicted_churn")
    loaded = churn.score(churn.load_model(path), rows, PLATS).select("user_id", F.col("churn_probability").alias("p"), F.col("predicted_churn").alias("y"))
    changed = (F.col("churn_probability") != F.col("p")) | (F.col("predicted_churn") != F.col("y"))
    scores = kept.join(loaded, "user_id").agg(F.count(F.lit(1)).alias("users"), F.count_if(changed).alias("changed_by_saving"))
    split = churn.stratified_split(churn.feature_matrix(u, PLATS))
    mean = split.where("NOT is_test").agg(F.avg("total_events")).first()[0]
    tested = split.where("is_test").withColumn("rule", (F.col("total_events") < mean).cast("int"))
    for i, (_, model) in enumerate(sorted(trained.models.items())):
        told = churn.score(model, rows, PLATS).select("user_id", F.col("predicted_churn").alias(f"m{i}"))
        tested = tested.join(told, "user_id")

    def f1(p: str):
        y, p = F.col("churn_status"), F.col(p)
        tp, wrong = F.count_if((y == 1) & (p == 1)), F.count_if(y != p)
        return F.when(tp > 0, 2.0 * tp / (2.0 * tp + wrong)).otherwise(F.lit(0.0))

    names = sorted(trained.models)
    again = tested.agg(F.count(F.lit(1)).alias("tested"), f1("rule").alias("rule"), *[f1(f"m{i}").alias(n) for i, n in enumerate(names)])
    f1s = again.unpivot(["tested", "rule"], names, "model", "again").join(trained.comparison, "model")
    order = F.array_position(F.array(*[F.lit(n) for n in churn.classifiers(1)]), F.col("model"))
    models = f1s.agg(
        F.max("tested").alias("tested"),
        F.count_if(F.abs(F.col("again") - F.col("f1_score")) > 1e-12).alias("wrong_f1"),
        (F.max_by("model", F.struct("again", -order)) != F.max(F.when(F.col("is_best"), F.col("model")))).cast("bigint").alias("wrong_best"),
        F.floor(F.max("rule") * 1_000_000).alias("rule_f1_millionths"),
        (F.max("again") > F.max("rule")).cast("bigint").alias("best_beats_rule"),
    )
    return scores.unpivot([], scores.columns, "what", "value").unionByName(models.unpivot([], models.columns, "what", "value"))
