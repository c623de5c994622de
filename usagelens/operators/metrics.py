"""Product metrics over fact rows (date / week / year already added).

Every metric is one ``groupBy``: Spark aggregates partially on the map side,
shuffles only the per-task partial rows on the group key and finishes.  Exact
distinct counts plan as two aggregation levels (first on (key, user), then on
key), so a hot day or week is spread over the first shuffle by user.
Null group keys are dropped, as the original pipeline did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.dates import week_monday, week_start_from_parts
from usagelens.columns import require


def dau(facts: DataFrame) -> DataFrame:
    """Daily active users: exact distinct users per date."""
    require(facts, "date", "user_id")
    return (
        facts.where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(F.countDistinct("user_id").alias("active_users"))
    )


def wau(facts: DataFrame) -> DataFrame:
    """Weekly active users per (year, week) as given by the fact rows."""
    require(facts, "year", "week", "user_id")
    return (
        facts.where(F.col("year").isNotNull() & F.col("week").isNotNull())
        .groupBy("year", "week")
        .agg(F.countDistinct("user_id").alias("active_users"))
    )


def wau_iso(facts: DataFrame) -> DataFrame:
    """Weekly active users keyed by true ISO (year, week), with the week's Monday."""
    require(facts, "date", "user_id")
    d = F.col("date")
    keyed = facts.where(d.isNotNull()).select(
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("year"),
        F.weekofyear(d).cast("int").alias("week"),
        week_monday(d).alias("week_start_date"),
        "user_id",
    )
    return keyed.groupBy("year", "week", "week_start_date").agg(
        F.countDistinct("user_id").alias("active_users")
    )


def with_week_start(weekly: DataFrame) -> DataFrame:
    """Add ``week_start_date`` by the warehouse rule (see ``week_start_from_parts``)."""
    return weekly.withColumn("week_start_date", week_start_from_parts("year", "week"))


def top_features(facts: DataFrame) -> DataFrame:
    """Events per feature, most used first (ties by name); null features dropped."""
    return (
        facts.where(F.col("feature_used").isNotNull())
        .groupBy("feature_used")
        .agg(F.count(F.lit(1)).alias("usage_count"))
        .orderBy(F.desc("usage_count"), F.asc("feature_used"))
    )


def top_features_n(facts: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most used features (a top-k report: ``TakeOrderedAndProject``)."""
    return top_features(facts).limit(n)


def feature_usage_over_time(facts: DataFrame) -> DataFrame:
    """Non-null feature events per (date, feature)."""
    return (
        facts.where(F.col("date").isNotNull() & F.col("feature_used").isNotNull())
        .groupBy("date", "feature_used")
        .agg(F.count("feature_used").alias("usage_count"))
    )


def activity_range(facts: DataFrame) -> DataFrame:
    """First and last activity date and the number of rows, as one row."""
    return facts.agg(
        F.date_format(F.min("date"), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("last_date"),
        F.count(F.lit(1)).alias("n_events"),
        F.countDistinct("date").alias("n_days"),
    )
