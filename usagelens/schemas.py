"""Explicit schemas and the fixed values the pipeline depends on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for right results)
# ---------------------------------------------------------------------------
# Platforms of the application logs, in the order the user table lists them.
DEFAULT_PLATFORMS = ["desktop_app", "mobile_android", "mobile_ios", "web"]
# Session length bounds in seconds.
SESSION_MIN_SEC = 5
SESSION_MAX_SEC = 3600
# Churn: no activity for more than this many days before the snapshot date.
CHURN_THRESHOLD_DAYS = 30
# Hold-out share and seed of the stratified split.
TEST_SIZE = 0.2
RANDOM_STATE = 42
# Oversample the minority class when count(class 0) / count(class 1) exceeds this.
IMBALANCE_RATIO = 1.5
# k-means: clusters and restarts; SMOTE neighbours.
N_CLUSTERS = 4
N_INIT = 10
SMOTE_K = 5
# Segment names given to the four clusters.
SEGMENT_NAMES = ["Power Users", "Regular Users", "At-Risk Users", "Feature Explorers"]
# Default category for a feature missing from the catalog.
UNKNOWN_CATEGORY = "Unknown"
# Warehouse string limits (user_id, Segment/category, feature, platform).
LEN_USER_ID = 36
LEN_CATEGORY = 50
LEN_FEATURE = 100
LEN_PLATFORM = 20
# ---------------------------------------------------------------------------

# Raw application log record (JSON / CSV edge format).
RAW_EVENT = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("category_used", T.StringType()),
        T.StructField("feature_used", T.StringType()),
        T.StructField("session_length", T.LongType()),
        T.StructField("platform", T.StringType()),
    ]
)

# Activity rows as the pipeline uses them after normalisation of the timestamp.
ACTIVITY = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("category_used", T.StringType()),
        T.StructField("feature_used", T.StringType()),
        T.StructField("session_length", T.LongType()),
        T.StructField("platform", T.StringType()),
    ]
)

# Transformed fact rows (raw columns + date, ISO week, calendar year), file order.
FACT_EVENTS_FILE = T.StructType(
    ACTIVITY.fields
    + [
        T.StructField("date", T.DateType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
    ]
)

# Nested feature catalog.
FEATURE_CATALOG = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("category", T.StringType()),
                        T.StructField("description", T.StringType()),
                        T.StructField("sub_features", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        )
    ]
)

USER_FEATURE_BASE = [
    "total_session_length_minutes",
    "average_session_length_minutes",
    "login_frequency",
    "unique_features_used",
    "unique_categories_used",
    "total_events",
]


def platform_columns(platforms: list[str]) -> list[str]:
    return [f"platform_{p}_count" for p in platforms]


# ---- warehouse tables (typed targets of the loaders) ------------------------
# Fixed contract values: table and column names, types, keys and limits.  Counts
# and sums are 64-bit; only calendar parts and day differences are 32-bit.

DIM_USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("Segment", T.StringType()),
        T.StructField("average_session_length_minutes", T.DecimalType(10, 2)),
        T.StructField("churn_probability", T.DecimalType(5, 4)),
        T.StructField("days_since_last_login", T.IntegerType()),
        T.StructField("last_login_date", T.DateType()),
        T.StructField("login_frequency", T.DecimalType(10, 2)),
        T.StructField("platform_desktop_app_count", T.LongType()),
        T.StructField("platform_mobile_android_count", T.LongType()),
        T.StructField("platform_mobile_ios_count", T.LongType()),
        T.StructField("platform_web_count", T.LongType()),
        T.StructField("predicted_churn", T.BooleanType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("total_session_length_minutes", T.DecimalType(10, 2)),
        T.StructField("unique_categories_used", T.LongType()),
        T.StructField("unique_features_used", T.LongType()),
    ]
)

FACT_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("category_used", T.StringType()),
        T.StructField("feature_used", T.StringType()),
        T.StructField("session_length_sec", T.LongType()),
        T.StructField("platform", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
    ]
)

FACT_DAILY_ACTIVE_USERS = T.StructType(
    [
        T.StructField("activity_date", T.DateType()),
        T.StructField("daily_active_users", T.LongType()),
    ]
)

FACT_WEEKLY_ACTIVE_USERS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("weekly_active_users", T.LongType()),
        T.StructField("week_start_date", T.DateType()),
    ]
)

FACT_FEATURE_USAGE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("daily_usage_count", T.LongType()),
    ]
)

FACT_FEATURE_SUMMARY = T.StructType(
    [
        T.StructField("feature_used", T.StringType()),
        T.StructField("usage_count", T.LongType()),
    ]
)

# Declared constraints of the warehouse tables: primary keys, not-null columns,
# string length limits.
PRIMARY_KEYS = {
    "DIM_USERS": ["user_id"],
    "FACT_DAILY_ACTIVE_USERS": ["activity_date"],
    "FACT_FEATURE_SUMMARY": ["feature_used"],
}
NOT_NULL = {"FACT_EVENTS": ["user_id", "timestamp"]}
LENGTH_LIMITS = {
    "DIM_USERS": {"user_id": LEN_USER_ID, "Segment": LEN_CATEGORY},
    "FACT_EVENTS": {
        "user_id": LEN_USER_ID,
        "category_used": LEN_CATEGORY,
        "feature_used": LEN_FEATURE,
        "platform": LEN_PLATFORM,
    },
    "FACT_FEATURE_USAGE": {"feature_name": LEN_FEATURE},
    "FACT_FEATURE_SUMMARY": {"feature_used": LEN_FEATURE},
}
