"""Registered queries: per-user features, recency, churn labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.functions.dates import strict_date
from usagelens.operators import users
from usagelens.plans.oracle_sql import churn_users_cte, facts_cte, platform_aggs, user_features_select
from usagelens.plans.q_etl import facts
from usagelens.plans.registry import register
from usagelens.sources import adapters

CHURN_DAYS = adapters.ORDERS_CHURN_DAYS


def _uf_sql(src: str) -> str:
    return f"""WITH {facts_cte(src)}
SELECT {user_features_select(src)} FROM facts WHERE user_id IS NOT NULL GROUP BY user_id"""


for _src, _sfx in (("events", ""), ("orders", "_orders")):

    def _bind(src: str, sfx: str):
        plats = adapters.platforms_of(src)
        register(f"user_features{sfx}", _uf_sql(src))(
            lambda spark, d: users.user_features(facts(spark, d, src), plats)
        )
        register(
            f"platform_counts{sfx}",
            f"WITH {facts_cte(src)} SELECT user_id, {platform_aggs(src)} FROM facts "
            "WHERE user_id IS NOT NULL GROUP BY user_id",
        )(lambda spark, d: users.platform_counts(facts(spark, d, src), plats))

    _bind(_src, _sfx)


@register("user_features_discovered", _uf_sql("events"))
def q_user_features_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pivot's columns are the platforms found in the data."""
    return users.user_features(facts(spark, sf_dir, "events"), None)


@register("user_features_sets", _uf_sql("orders"))
def q_user_features_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same table through the one-exchange plan (per-user sets instead of Expand)."""
    return users.user_features(facts(spark, sf_dir, "orders"), adapters.ORDERS_PLATFORMS, distinct_mode="sets")


@register("user_features_expand", _uf_sql("orders"))
def q_user_features_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same table through ``countDistinct`` (Expand + two exchanges)."""
    return users.user_features(facts(spark, sf_dir, "orders"), adapters.ORDERS_PLATFORMS, distinct_mode="exact")


_RECENCY_SQL = f"""WITH {facts_cte('orders')}
SELECT u.user_id, u.last_login_date,
       CAST(date_diff('day', u.last_login_date, (SELECT max("date") FROM facts)) AS INTEGER) AS days_since_last_login
FROM (SELECT user_id, max("date") AS last_login_date FROM facts WHERE user_id IS NOT NULL GROUP BY user_id) u"""


@register("user_recency_from_text", _RECENCY_SQL)
def q_user_recency_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates come as text and are parsed strictly: a bad one would stop the job."""
    fx = facts(spark, sf_dir, "orders")
    return users.user_recency(fx.withColumn("date", strict_date(F.col("date").cast("string"))))


@register("user_recency", _RECENCY_SQL)
def q_user_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.user_recency(facts(spark, sf_dir, "orders"))


@register("churn_labels", f"WITH {facts_cte('orders')}, {churn_users_cte('orders', CHURN_DAYS)} SELECT * FROM users")
def q_churn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.churn_users(facts(spark, sf_dir, "orders"), adapters.ORDERS_PLATFORMS, CHURN_DAYS)


@register(
    "churn_distribution",
    f"""WITH {facts_cte('orders')}, {churn_users_cte('orders', CHURN_DAYS)}
SELECT churn_status, count(*) AS users FROM users GROUP BY churn_status""",
)
def q_churn_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.churn_distribution(
        users.churn_users(facts(spark, sf_dir, "orders"), adapters.ORDERS_PLATFORMS, CHURN_DAYS)
    )


@register(
    "churn_distribution_30d",
    f"""WITH {facts_cte('orders')}, {churn_users_cte('orders', 30)}
SELECT churn_status, count(*) AS users FROM users GROUP BY churn_status""",
)
def q_churn_distribution_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.churn_distribution(users.churn_users(facts(spark, sf_dir, "orders"), adapters.ORDERS_PLATFORMS, 30))


@register(
    "unlisted_platforms",
    f"""WITH {facts_cte('events')}
SELECT platform, count(*) AS events FROM facts
WHERE platform IS NOT NULL AND platform NOT IN ({', '.join(repr(p) for p in schemas.DEFAULT_PLATFORMS)})
GROUP BY platform""",
)
def q_unlisted_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose platform is outside the default four-platform list: with a
    fixed pivot list these would be in no ``platform_*_count`` column."""
    return users.unlisted_platforms(facts(spark, sf_dir, "events"), schemas.DEFAULT_PLATFORMS)
