"""Dashboard KPIs: weekly retention by cohort, churn and engagement by segment,
feature use by segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.functions.dates import week_monday


def weekly_retention(facts: DataFrame) -> DataFrame:
    """cohort_week (Monday of a user's first active week), weeks_since,
    active_users and retention = active_users / cohort size.

    One shuffle by user: each user's active weeks are gathered as a sorted set
    (at most one entry per week of history, merged map-side, so a very active
    user costs one partial set per task); the first entry is the cohort.
    """
    per_user = (
        facts.where(F.col("user_id").isNotNull() & F.col("date").isNotNull())
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_set(week_monday("date"))).alias("weeks"))
    )
    active = per_user.select(F.col("weeks")[0].alias("cohort_week"), F.explode("weeks").alias("week"))
    counts = (
        active.withColumn("weeks_since", (F.datediff("week", "cohort_week") / 7).cast("int"))
        .groupBy("cohort_week", "weeks_since")
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    # one row per (cohort, week offset): a small table
    size = F.max(F.when(F.col("weeks_since") == 0, F.col("active_users"))).over(Window.partitionBy("cohort_week"))
    return counts.withColumn("cohort_size", size).withColumn(
        "retention", F.col("active_users").cast("double") / F.col("cohort_size").cast("double")
    )


def churn_summary(scored: DataFrame) -> DataFrame:
    """Per segment: users, mean churn probability, share predicted to churn."""
    return scored.groupBy("Segment").agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("churn_probability").alias("avg_churn_probability"),
        F.avg(F.col("predicted_churn").cast("double")).alias("predicted_churn_share"),
    )


def segment_engagement(scored: DataFrame, at_risk_probability: float = 0.5) -> DataFrame:
    """Per segment: mean usage features and how many users are at risk."""
    return scored.groupBy("Segment").agg(
        F.count(F.lit(1)).alias("users"),
        *[F.avg(c).alias(f"avg_{c}") for c in schemas.USER_FEATURE_BASE],
        F.count_if(F.col("churn_probability") >= at_risk_probability).alias("users_at_risk"),
    )


def at_risk_users(scored: DataFrame, segment: str | None = None, min_probability: float = 0.5) -> DataFrame:
    cond = F.col("churn_probability") >= min_probability
    if segment is not None:
        cond = cond & (F.col("Segment") == segment)
    return scored.where(cond)


def feature_by_segment(facts: DataFrame, segments: DataFrame) -> DataFrame:
    """Events per (segment, feature).  Events are first summed per (user,
    feature) - at most one row per user and feature reaches the join - then
    joined to the one-row-per-user segment table."""
    per_user = (
        facts.where(F.col("user_id").isNotNull() & F.col("feature_used").isNotNull())
        .groupBy("user_id", "feature_used")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    joined = per_user.join(segments.select("user_id", "Segment"), "user_id")
    return joined.groupBy("Segment", "feature_used").agg(
        F.sum("events").alias("events"), F.count(F.lit(1)).alias("users")
    )
