"""Shape the supplied tables as application activity rows.

Activity rows have the raw log columns: user_id, timestamp, category_used,
feature_used, session_length, platform.  Two adapters are provided:

* ``events``  -> a product-analytics log (30 days, 150 users per 0.01 SF);
* ``orders``  -> a long history (1995..2001) with year boundaries and real churn.

Both read only the columns they need, so the Parquet scan is pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.functions.scalars import clamp
from usagelens.sources.catalog import enrich_category

# ---------------------------------------------------------------------------
# Fixed values of the supplied test tables
# ---------------------------------------------------------------------------
# events.event_type values, used as the platform list of the events adapter.
EVENTS_PLATFORMS = ["click", "error", "purchase", "signup", "view"]
# orders.o_orderstatus values, used as the platform list of the orders adapter.
ORDERS_PLATFORMS = ["F", "O", "P"]
# events.props "k" -> feature number k % 20; features 0..17 are in the catalog,
# feature f belongs to category f % 7.
EVENTS_FEATURE_MODULUS = 20
EVENTS_CATALOG_FEATURES = 18
EVENTS_CATALOG_CATEGORIES = 7
# events.value -> session seconds
EVENTS_SESSION_SCALE = 40
# orders priorities counted as expedited
ORDERS_EXPEDITED = ["1-URGENT", "2-HIGH"]
# Churn threshold that gives both classes on the orders history.
ORDERS_CHURN_DAYS = 365
# ---------------------------------------------------------------------------

ACTIVITY_COLUMNS = [f.name for f in schemas.ACTIVITY.fields]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feature_name(num: F.Column) -> F.Column:
    return F.concat(F.lit("feature_"), F.lpad(num.cast("string"), 2, "0"))


def events_catalog(spark: SparkSession) -> DataFrame:
    """Catalog of the events table: (category, feature_name), built from its rule."""
    f = F.col("id")
    return spark.range(EVENTS_CATALOG_FEATURES).select(
        F.concat(F.lit("category_"), (f % EVENTS_CATALOG_CATEGORIES).cast("string")).alias("category"),
        feature_name(f).alias("feature_name"),
    )


def activity_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").try_cast("int")
    shaped = ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("timestamp"),
        feature_name(k % EVENTS_FEATURE_MODULUS).alias("feature_used"),
        clamp(
            F.round(F.col("value") * EVENTS_SESSION_SCALE).cast("bigint"),
            schemas.SESSION_MIN_SEC,
            schemas.SESSION_MAX_SEC,
        ).alias("session_length"),
        F.col("event_type").alias("platform"),
    )
    enriched = enrich_category(shaped, events_catalog(spark))
    return enriched.select(*ACTIVITY_COLUMNS)


def activity_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice", "o_orderstatus"
    )
    return o.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.when(F.col("o_orderpriority").isin(ORDERS_EXPEDITED), F.lit("expedited"))
        .otherwise(F.lit("standard"))
        .alias("category_used"),
        F.col("o_orderpriority").alias("feature_used"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("session_length"),
        F.col("o_orderstatus").alias("platform"),
    )


ADAPTERS = {
    "events": (activity_from_events, EVENTS_PLATFORMS),
    "orders": (activity_from_orders, ORDERS_PLATFORMS),
}


def activity(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    return ADAPTERS[source][0](spark, sf_dir)


def platforms_of(source: str) -> list[str]:
    return ADAPTERS[source][1]
