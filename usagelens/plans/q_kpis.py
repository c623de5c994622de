"""Registered queries: retention, and the segment / churn dashboard KPIs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.operators import kpis, reconcile, users
from usagelens.plans import churn, segments, views
from usagelens.plans.oracle_sql import churn_users_cte, facts_cte
from usagelens.plans.q_etl import facts
from usagelens.plans.q_warehouse import dim_users_table
from usagelens.plans.registry import register
from usagelens.session import scratch_path
from usagelens.sources import adapters, warehouse

PLATS = adapters.ORDERS_PLATFORMS


def _retention_sql(src: str) -> str:
    return f"""WITH {facts_cte(src)},
uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', "date") AS DATE) AS week FROM facts
       WHERE user_id IS NOT NULL AND "date" IS NOT NULL),
f AS (SELECT *, min(week) OVER (PARTITION BY user_id) AS cohort_week FROM uw),
c AS (SELECT cohort_week, CAST(date_diff('day', cohort_week, week) / 7 AS INTEGER) AS weeks_since,
             count(*) AS active_users FROM f GROUP BY 1, 2),
s AS (SELECT *, max(CASE WHEN weeks_since = 0 THEN active_users END) OVER (PARTITION BY cohort_week) AS cohort_size FROM c)
SELECT *, CAST(active_users AS DOUBLE) / CAST(cohort_size AS DOUBLE) AS retention FROM s"""


@register("weekly_retention", _retention_sql("events"))
def q_weekly_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.weekly_retention(facts(spark, sf_dir, "events"))


@register("weekly_retention_orders", _retention_sql("orders"))
def q_weekly_retention_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.weekly_retention(facts(spark, sf_dir, "orders"))


def scored_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two model outputs joined per user: segment file + churn predictions.
    Segmentation and churn training are independent and run as concurrent jobs."""
    fx = facts(spark, sf_dir, "orders")
    # One pass over the events: the churn user table holds the segment features too.
    path = scratch_path(spark, "churn-users")
    users.churn_users(fx, PLATS, adapters.ORDERS_CHURN_DAYS).write.parquet(path)
    u = spark.read.parquet(path)
    feats = u.drop("last_login_date", "days_since_last_login", "churn_status")
    with ThreadPoolExecutor(max_workers=2) as pool:
        seg_f = pool.submit(segments.segment_users, feats)
        trained_f = pool.submit(churn.train_churn_models, u, PLATS)
        seg, trained = seg_f.result().assignments.drop("cluster"), trained_f.result()
    path = scratch_path(spark, "churn-model")
    churn.save_model(trained.model, path)
    scored = churn.score(churn.load_model(path), u.drop("churn_status"), PLATS)
    return reconcile.merge_tables(seg, scored)


@register("churn_summary")
def q_churn_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.churn_summary(scored_segments(spark, sf_dir))


@register("segment_engagement")
def q_segment_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.segment_engagement(scored_segments(spark, sf_dir))


@register("feature_by_segment")
def q_feature_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = facts(spark, sf_dir, "orders")
    seg = segments.segment_users(users.user_features(fx, PLATS)).assignments
    return kpis.feature_by_segment(fx, seg)


@register("dim_users_loaded")
def q_dim_users_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments + churn predictions merged, written in DIM_USERS order, loaded typed."""
    merged = scored_segments(spark, sf_dir)
    merged = merged.withColumn("predicted_churn", F.col("predicted_churn").cast("string"))
    return dim_users_table(spark, merged, PLATS)


# ---- the same KPIs over a rule instead of the two models, so that SQL can check them ----

_RULE_SEGMENT = "CASE WHEN total_events >= 15 THEN 'Power' WHEN total_events >= 8 THEN 'Regular' ELSE 'Light' END"
# Sixteenths: exact in binary and in four decimals.
_RULE_PROBABILITY = "least(days_since_last_login DIV 128, 16) / 16.0D"
_RULE_CTE = f"""{facts_cte('orders')}, {churn_users_cte('orders', adapters.ORDERS_CHURN_DAYS)},
scored AS (SELECT * REPLACE (floor(average_session_length_minutes) AS average_session_length_minutes),
  {_RULE_SEGMENT} AS "Segment", CAST(least(days_since_last_login // 128, 16) AS DOUBLE) / 16.0 AS churn_probability,
  days_since_last_login > {adapters.ORDERS_CHURN_DAYS} AS predicted_churn FROM users)"""


def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User rows with a segment, a churn probability and a prediction by rule."""
    u = users.churn_users(facts(spark, sf_dir, "orders"), PLATS, adapters.ORDERS_CHURN_DAYS)
    u = u.withColumn("average_session_length_minutes", F.floor("average_session_length_minutes").cast("double"))
    return u.withColumns(
        {
            "Segment": F.expr(_RULE_SEGMENT),
            "churn_probability": F.expr(_RULE_PROBABILITY),
            "predicted_churn": F.col("days_since_last_login") > adapters.ORDERS_CHURN_DAYS,
        }
    )


@register(
    "churn_summary_rule",
    f"""WITH {_RULE_CTE}
SELECT "Segment", count(*) AS users, avg(churn_probability) AS avg_churn_probability,
       avg(CAST(CAST(predicted_churn AS INTEGER) AS DOUBLE)) AS predicted_churn_share FROM scored GROUP BY "Segment" """,
)
def q_churn_summary_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.churn_summary(rule_scored(spark, sf_dir).withColumn("predicted_churn", F.col("predicted_churn").cast("int")))


@register(
    "segment_engagement_rule",
    f"""WITH {_RULE_CTE}
SELECT "Segment", count(*) AS users, {", ".join(f"avg({c}) AS avg_{c}" for c in schemas.USER_FEATURE_BASE)},
       count_if(churn_probability >= 0.5) AS users_at_risk FROM scored GROUP BY "Segment" """,
)
def q_segment_engagement_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.segment_engagement(rule_scored(spark, sf_dir))


@register(
    "feature_by_segment_rule",
    f"""WITH {_RULE_CTE}
SELECT s."Segment", f.feature_used, count(*) AS events, count(DISTINCT f.user_id) AS users
FROM facts f JOIN scored s ON f.user_id = s.user_id WHERE f.feature_used IS NOT NULL GROUP BY 1, 2""",
)
def q_feature_by_segment_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.feature_by_segment(facts(spark, sf_dir, "orders"), rule_scored(spark, sf_dir))


@register(
    "at_risk_users",
    f"""WITH {_RULE_CTE}
SELECT user_id, "Segment", churn_probability FROM scored WHERE churn_probability >= 0.5 AND "Segment" = 'Regular'""",
)
def q_at_risk_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of one segment whose churn probability reaches the threshold."""
    return kpis.at_risk_users(rule_scored(spark, sf_dir), "Regular", 0.5).select("user_id", "Segment", "churn_probability")


_RULE_DIM_SQL = f"""WITH {_RULE_CTE}
SELECT user_id, "Segment", CAST(average_session_length_minutes AS DECIMAL(10,2)) AS average_session_length_minutes,
  CAST(churn_probability AS DECIMAL(5,4)) AS churn_probability,
  CAST(days_since_last_login AS INTEGER) AS days_since_last_login, last_login_date,
  CAST(login_frequency AS DECIMAL(10,2)) AS login_frequency,
  {", ".join(f"CAST(platform_{p}_count AS BIGINT) AS platform_{p}_count" for p in PLATS)},
  predicted_churn, CAST(total_events AS BIGINT) AS total_events,
  CAST(total_session_length_minutes AS DECIMAL(10,2)) AS total_session_length_minutes,
  CAST(unique_categories_used AS BIGINT) AS unique_categories_used,
  CAST(unique_features_used AS BIGINT) AS unique_features_used FROM scored"""


@register("dim_users_filled", _RULE_DIM_SQL)
def q_dim_users_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All DIM_USERS columns filled (booleans and decimal(5,4) too), written as CSV and loaded typed."""
    return dim_users_table(spark, rule_scored(spark, sf_dir), PLATS)


@register("view_user_profile_filled", _RULE_DIM_SQL)
def q_view_user_profile_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile view over a stored DIM_USERS table with filled model columns."""
    table = scratch_path(spark, "dim-users-table")
    warehouse.save_table(dim_users_table(spark, rule_scored(spark, sf_dir), PLATS), table)
    return views.user_profile(spark.read.parquet(table), PLATS)
