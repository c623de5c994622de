"""Dashboard views over the warehouse tables (plain projections and one join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens import schemas

PROFILE_BASE = [
    "user_id",
    "Segment",
    "average_session_length_minutes",
    "churn_probability",
    "predicted_churn",
    "days_since_last_login",
    "login_frequency",
]
PROFILE_TAIL = [
    "total_events",
    "total_session_length_minutes",
    "unique_categories_used",
    "unique_features_used",
    "last_login_date",
]


def user_profile(dim_users: DataFrame, platforms: list[str] = schemas.DEFAULT_PLATFORMS) -> DataFrame:
    return dim_users.select(*PROFILE_BASE, *schemas.platform_columns(platforms), *PROFILE_TAIL)


def feature_usage_trends(usage: DataFrame, summary: DataFrame) -> DataFrame:
    """Daily usage per feature with the feature's all-time total.

    The summary has one row per feature; Spark picks the join from its measured size.
    """
    fs = summary.select("feature_used", F.col("usage_count").alias("total_usage_count"))
    joined = usage.join(fs, usage["feature_name"] == fs["feature_used"], "left")
    return joined.select("date", "feature_name", "daily_usage_count", "total_usage_count")


def event_history(fact_events: DataFrame) -> DataFrame:
    return fact_events.select("user_id", "date", "category_used", "feature_used", "platform", "session_length_sec")


def daily_active_users(dau_table: DataFrame) -> DataFrame:
    return dau_table.select("activity_date", "daily_active_users")


def weekly_active_users(wau_table: DataFrame) -> DataFrame:
    return wau_table.select("year", "week", "weekly_active_users", "week_start_date")
