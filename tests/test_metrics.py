import datetime as dt

from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.operators import metrics, normalize


def _raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_EVENT)


def _facts(spark, rows):
    return normalize.events_normalized(_raw(spark, rows))


def test_calendar_year_with_iso_week(spark):
    f = _facts(
        spark,
        [
            ("u1", "2024-12-30T10:00:00", "c", "f", 10, "web"),  # ISO week 1 of 2025, calendar 2024
            ("u2", "2023-01-01T10:00:00", "c", "f", 10, "web"),  # ISO week 52 of 2022
            ("u3", "2021-06-15T10:00:00", "c", "f", 10, "web"),
        ],
    )
    got = {(r.user_id): (r.year, r.week) for r in f.collect()}
    assert got["u1"] == (2024, 1)
    assert got["u2"] == (2023, 52)
    assert got["u3"] == (2021, 24)
    iso = {tuple(r)[:3] for r in metrics.wau_iso(f).collect()}
    assert (2025, 1, dt.date(2024, 12, 30)) in iso
    assert (2022, 52, dt.date(2022, 12, 26)) in iso


def test_week_start_rule(spark):
    df = spark.createDataFrame([(2021, 24), (2024, 1), (2020, 53), (2023, 1)], "year int, week int")
    got = {(r.year, r.week): r.week_start_date for r in metrics.with_week_start(df).collect()}
    # 1 Jan 2021 is a Friday: the rule lands 7 days before the true Monday (2021-06-14).
    assert got[(2021, 24)] == dt.date(2021, 6, 7)
    # 1 Jan 2024 is a Monday: the rule is right.
    assert got[(2024, 1)] == dt.date(2024, 1, 1)
    # 1 Jan 2020 is a Wednesday: Monday before it.
    assert got[(2020, 53)] == dt.date(2019, 12, 30) + dt.timedelta(days=52 * 7)
    # 1 Jan 2023 is a Sunday.
    assert got[(2023, 1)] == dt.date(2022, 12, 26)


def test_null_keys_dropped_and_distinct_exact(spark):
    f = _facts(
        spark,
        [
            ("u1", "2024-01-01T01:00:00", "c", "a", 10, "web"),
            ("u1", "2024-01-01T02:00:00", "c", "a", 10, "web"),
            ("u2", "2024-01-01T03:00:00", "c", None, 10, "web"),
            (None, "2024-01-01T04:00:00", "c", "b", 10, "web"),
            ("u3", "not a time", "c", "b", 10, "web"),
        ],
    )
    dau = {r.date: r.active_users for r in metrics.dau(f).collect()}
    assert dau == {dt.date(2024, 1, 1): 2}  # null user not counted, bad timestamp has no date
    top = [tuple(r) for r in metrics.top_features(f).collect()]
    assert top == [("a", 2), ("b", 2)]  # null feature dropped; tie broken by name
    usage = {(r.date, r.feature_used): r.usage_count for r in metrics.feature_usage_over_time(f).collect()}
    assert usage == {(dt.date(2024, 1, 1), "a"): 2, (dt.date(2024, 1, 1), "b"): 1}


def test_top_features_tie_break_and_limit(spark):
    rows = [("u", "2024-01-01T00:00:00", "c", f, 1, "web") for f in ["z", "z", "y", "y", "x"]]
    f = _facts(spark, rows)
    assert [r.feature_used for r in metrics.top_features_n(f, 2).collect()] == ["y", "z"]


def test_properties_on_supplied_data(spark):
    from usagelens.plans.q_etl import facts

    fx = facts(spark, "/root/testdata/sf0.001", "orders")
    dau = metrics.dau(fx).agg(F.max("active_users")).first()[0]
    wau = metrics.wau(fx).agg(F.min("active_users")).first()[0]
    assert dau >= 1 and wau >= 1
    # every day's users are among that week's users
    joined = metrics.dau(fx).withColumn("year", F.year("date")).withColumn("week", F.weekofyear("date"))
    j = joined.join(metrics.wau(fx).withColumnRenamed("active_users", "w"), ["year", "week"])
    assert j.where(F.col("active_users") > F.col("w")).count() == 0
    s_usage = metrics.feature_usage_over_time(fx).agg(F.sum("usage_count")).first()[0]
    s_top = metrics.top_features(fx).agg(F.sum("usage_count")).first()[0]
    assert s_usage == s_top == fx.count()


def test_repartition_invariance(spark):
    from usagelens.plans.q_etl import facts

    fx = facts(spark, "/root/testdata/sf0.001", "events")
    a = sorted(tuple(r) for r in metrics.dau(fx).collect())
    b = sorted(tuple(r) for r in metrics.dau(fx.repartition(7).orderBy(F.rand(1))).collect())
    assert a == b
