import datetime as dt

import pytest
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.functions.scalars import nan_to_null
from usagelens.operators import normalize, users


def _facts(spark, rows):
    return normalize.events_normalized(spark.createDataFrame(rows, schemas.RAW_EVENT))


def test_bad_timestamp_kept_then_dropped(spark):
    f = _facts(spark, [("u1", "2024-01-01T00:00:00", "c", "f", 5, "web"), ("u2", "garbage", "c", "f", 5, "web")])
    rows = {r.user_id: r for r in f.collect()}
    assert rows["u2"].timestamp is None and rows["u2"].date is None
    assert rows["u1"].timestamp == dt.datetime(2024, 1, 1)
    assert [r.user_id for r in normalize.drop_null_timestamps(f).collect()] == ["u1"]


def test_clamp_bounds(spark):
    df = spark.createDataFrame([(4,), (5,), (3600,), (3601,), (None,)], "session_length long")
    got = [r.session_length for r in normalize.clamp_sessions(df).collect()]
    assert got == [5, 5, 3600, 3600, None]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert [r.x for r in df.select(nan_to_null("x").alias("x")).collect()] == [1.0, None]


def test_user_features_null_rules(spark):
    f = _facts(
        spark,
        [
            ("u1", "2024-01-01T00:00:00", "c1", "a", 10, "web"),
            ("u1", "2024-01-02T00:00:00", "c2", "b", 20, "mobile_ios"),
            ("u1", "2024-01-02T05:00:00", None, None, None, None),
            ("u2", "2024-01-03T00:00:00", "c1", "a", None, None),  # only null platforms / lengths
            (None, "2024-01-03T00:00:00", "c1", "a", 7, "web"),
        ],
    )
    got = {r.user_id: r.asDict() for r in users.user_features(f).collect()}
    assert set(got) == {"u1", "u2"}
    u1, u2 = got["u1"], got["u2"]
    assert u1["total_session_length_minutes"] == 30
    assert u1["average_session_length_minutes"] == 15.0  # mean skips nulls
    assert u1["login_frequency"] == 2
    assert u1["unique_features_used"] == 2 and u1["unique_categories_used"] == 2
    assert u1["total_events"] == 3  # size counts every row
    assert u1["platform_web_count"] == 1 and u1["platform_mobile_ios_count"] == 1
    assert u1["platform_desktop_app_count"] == 0
    assert u2["total_session_length_minutes"] == 0 and u2["average_session_length_minutes"] == 0.0
    assert all(u2[c] == 0 for c in schemas.platform_columns(schemas.DEFAULT_PLATFORMS))
    assert list(users.user_features(f).columns[:7]) == ["user_id"] + schemas.USER_FEATURE_BASE


def test_distinct_modes_agree(spark):
    from usagelens.plans.q_etl import facts

    fx = facts(spark, "/root/testdata/sf0.001", "orders")
    a = users.user_features(fx, ["F", "O", "P"], "exact")
    b = users.user_features(fx, ["F", "O", "P"], "sets")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_churn_threshold_is_strict(spark):
    f = _facts(
        spark,
        [
            ("a", "2024-03-01T00:00:00", "c", "f", 1, "web"),  # snapshot day
            ("b", "2024-01-31T00:00:00", "c", "f", 1, "web"),  # 30 days before
            ("c", "2024-01-30T00:00:00", "c", "f", 1, "web"),  # 31 days before
        ],
    )
    got = {r.user_id: (r.days_since_last_login, r.churn_status) for r in users.churn_users(f, threshold_days=30).collect()}
    assert got == {"a": (0, 0), "b": (30, 0), "c": (31, 1)}


def test_unlisted_platforms_counted(spark):
    f = _facts(spark, [("a", "2024-03-01T00:00:00", "c", "f", 1, "smart_tv"), ("a", "2024-03-01T00:00:00", "c", "f", 1, "web")])
    assert [tuple(r) for r in users.unlisted_platforms(f, schemas.DEFAULT_PLATFORMS).collect()] == [("smart_tv", 1)]


def test_user_features_plan_has_no_join(spark):
    from usagelens.plans.q_etl import facts

    plan = users.churn_users(facts(spark, "/root/testdata/sf0.001", "orders"), ["F", "O", "P"], 365)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text  # platform pivot and last login fused into one aggregate
    assert "CartesianProduct" not in text


@pytest.mark.parametrize("days,expect", [(30, 0), (31, 1)])
def test_churn_label_column(spark, days, expect):
    df = spark.createDataFrame([(days,)], "d int")
    assert df.select(users.churn_label("d", 30).alias("x")).first().x == expect


def test_hot_user_with_a_third_of_rows(spark):
    n = 30000
    df = spark.range(0, n, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 500).cast("string"))).alias("user_id"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 40 as int), 0, 0, 0)").alias("timestamp"),
        F.lit("c").alias("category_used"),
        F.concat(F.lit("f"), (F.col("id") % 7).cast("string")).alias("feature_used"),
        F.lit(10).cast("long").alias("session_length"),
        F.lit("web").alias("platform"),
    )
    f = normalize.add_calendar(df)
    hot = users.user_features(f).where("user_id = 'hot'").first()
    assert hot.total_events == n // 3 and hot.login_frequency == 40 and hot.unique_features_used == 7
    assert hot.platform_web_count == n // 3 and hot.total_session_length_minutes == 10 * (n // 3)
