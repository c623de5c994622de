import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas
from usagelens.operators import checks, ids
from usagelens.sources import warehouse

TARGET = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("last_login_date", T.DateType()),
        T.StructField("score", T.DecimalType(5, 4)),
        T.StructField("flag", T.BooleanType()),
        T.StructField("n", T.IntegerType()),
    ]
)
LIMITS = {"user_id": 8}


def _write(d, name, lines):
    with open(os.path.join(d, name), "w") as fh:
        fh.write("user_id,last_login_date,score,flag,n\n")
        fh.write("\n".join(lines) + "\n")


@pytest.fixture()
def csv_dir(tmp_dir):
    d = os.path.join(tmp_dir, "in")
    os.makedirs(d)
    _write(d, "good.csv", ["a,2024-01-01,0.5,1,3", "b,2024-01-02,0.25,true,4", "c,,,0,"])
    _write(d, "bad_date.csv", ["d,2024-13-45,0.1,1,1", "e,2024-01-01,0.1,1,1"])
    _write(d, "too_many.csv", ["f,2024-01-01,0.1,1,1,extra"])
    _write(d, "too_long.csv", ["abcdefghijk,2024-01-01,0.1,1,1"])
    _write(d, "overflow.csv", ["g,2024-01-01,12.5,1,1"])
    _write(d, "bad_bool.csv", ["h,2024-01-01,0.1,maybe,1"])
    return d


def test_skip_file_keeps_only_clean_files(spark, csv_dir):
    got = warehouse.load_csv(spark, csv_dir, TARGET, "skip_file", max_len=LIMITS)
    rows = {r.user_id: r for r in got.collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"].flag is True and rows["b"].flag is True and rows["c"].flag is False
    assert rows["a"].score == decimal.Decimal("0.5000")
    assert rows["c"].last_login_date is None and rows["c"].n is None
    assert rows["a"].last_login_date == dt.date(2024, 1, 1)
    bad = {os.path.basename(r[0]) for r in warehouse.bad_files(spark, csv_dir, TARGET, max_len=LIMITS).collect()}
    assert bad == {"bad_date.csv", "too_many.csv", "too_long.csv", "overflow.csv", "bad_bool.csv"}


def test_skip_row_and_abort(spark, csv_dir):
    got = {r.user_id for r in warehouse.load_csv(spark, csv_dir, TARGET, "skip_row", max_len=LIMITS).collect()}
    assert got == {"a", "b", "c", "e"}
    with pytest.raises(ValueError):
        warehouse.load_csv(spark, csv_dir, TARGET, "abort", max_len=LIMITS).count()


def test_not_null_policy(spark, tmp_dir):
    d = os.path.join(tmp_dir, "nn")
    os.makedirs(d)
    _write(d, "one.csv", ["a,2024-01-01,0.5,1,3", ",2024-01-01,0.5,1,3"])
    _write(d, "two.csv", ["b,2024-01-01,0.5,1,3"])
    got = {r.user_id for r in warehouse.load_csv(spark, d, TARGET, not_null=["user_id"]).collect()}
    assert got == {"b"}


def test_positional_binding_ignores_header_names(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pos")
    os.makedirs(d)
    with open(os.path.join(d, "x.csv"), "w") as fh:
        fh.write("date,active_users\n2024-01-01,5\n")
    got = warehouse.load_csv(spark, d, schemas.FACT_DAILY_ACTIVE_USERS).collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 1, 1), 5)]


def test_column_list_load_renames(spark, tmp_dir):
    d = os.path.join(tmp_dir, "facts")
    os.makedirs(d)
    with open(os.path.join(d, "f.csv"), "w") as fh:
        fh.write("user_id,timestamp,category_used,feature_used,session_length,platform,date,week,year\n")
        fh.write("u1,2024-01-01T10:00:00.123456,c,f,42,web,2024-01-01,1,2024\n")
    from usagelens.plans.q_warehouse import load_fact_events

    r = load_fact_events(spark, d).first()
    assert r.session_length_sec == 42 and r.timestamp == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert "event_id" not in load_fact_events(spark, d).columns


def test_dense_ids_are_contiguous(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    out = ids.with_dense_id(df, ["k"], "rid")
    rows = out.orderBy("rid").collect()
    assert [r.rid for r in rows] == list(range(1, 5001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_rank_within_groups(spark):
    df = spark.createDataFrame([(g, i) for g in (0, 1) for i in range(50 if g == 0 else 7)], "g int, i int")
    out = ids.rank_within_groups(df, "g", [F.desc("i")], "r")
    got = {(r.g, r.i): r.r for r in out.collect()}
    assert got[(0, 49)] == 1 and got[(0, 0)] == 50 and got[(1, 6)] == 1 and got[(1, 0)] == 7


def test_constraint_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    pk = checks.primary_key_report(df, ["k"], "T").first()
    assert (pk.rows, pk.distinct_keys, pk.duplicate_keys, pk.null_keys) == (4, 3, 1, 1)
    nn = {r.column_name: r.violations for r in checks.not_null_report(df, ["k", "v"], "T").collect()}
    assert nn == {"k": 1, "v": 0}
    ln = {r.column_name: r.violations for r in checks.length_report(df, {"k": 0}, "T").collect()}
    assert ln == {"k": 3}


def test_dim_users_schema_order():
    s = warehouse.dim_users_schema(schemas.DEFAULT_PLATFORMS)
    assert s.names == schemas.DIM_USERS.names


def test_decimal_cast_rounds_half_up(spark):
    df = spark.createDataFrame([(2.675,), (123456789012.0,)], "x double")
    target = T.StructType([T.StructField("x", T.DecimalType(10, 2))])
    got = [r.x for r in warehouse.cast_to(df, target).collect()]
    assert got == [decimal.Decimal("2.68"), None]


def test_dense_ids_split_a_hot_key(spark):
    # a third of the rows share one sort key: they must not all land in one sort task
    df = spark.range(0, 3000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # keep the 8 range partitions visible on tiny data
    try:
        out = ids.with_dense_id(df, ["k"], "rid")
        assert sorted(r.rid for r in out.collect()) == list(range(1, 3001))
        per_task = out.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(key, "true")
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 1000


def test_three_column_wau_file_into_four_column_table(spark, tmp_dir):
    d = os.path.join(tmp_dir, "wau")
    os.makedirs(d)
    with open(os.path.join(d, "metrics_wau.csv"), "w") as fh:
        fh.write("year,week,active_users\n2021,24,5\n2024,1,7\n")
    # Bound to all four columns, every row has too few fields: the file is skipped.
    assert warehouse.load_csv(spark, d, schemas.FACT_WEEKLY_ACTIVE_USERS).count() == 0
    # Loaded into its three columns, with the week start derived, it is kept.
    from usagelens.operators.metrics import with_week_start

    three = T.StructType(schemas.FACT_WEEKLY_ACTIVE_USERS.fields[:3])
    got = {(r.year, r.week): r.week_start_date for r in with_week_start(warehouse.load_csv(spark, d, three)).collect()}
    assert got == {(2021, 24): dt.date(2021, 6, 7), (2024, 1): dt.date(2024, 1, 1)}


SUMMARY = schemas.FACT_FEATURE_SUMMARY


def _summary(d, name, lines):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write("feature_used,usage_count\n" + "\n".join(lines) + "\n")


def test_counts_beyond_32_bits_and_fractions(spark, tmp_dir):
    _summary(f"{tmp_dir}/n", "big.csv", ["f1,3000000000", "f2,5.0"])
    _summary(f"{tmp_dir}/n", "fraction.csv", ["f3,12.7"])
    _summary(f"{tmp_dir}/n", "tiny.csv", ["f4,12.0000001"])
    got = {r.feature_used: r.usage_count for r in warehouse.load_csv(spark, f"{tmp_dir}/n", SUMMARY).collect()}
    assert got == {"f1": 3000000000, "f2": 5}


def test_blank_required_value_is_missing(spark, tmp_dir):
    target = T.StructType([T.StructField("k", T.StringType()), T.StructField("ts", T.TimestampNTZType())])
    os.makedirs(f"{tmp_dir}/b")
    with open(f"{tmp_dir}/b/x.csv", "w") as fh:
        fh.write('k,ts\na,"  "\nb,never\nc,2024-01-01 00:00:00\n')
    flagged = warehouse.flagged_rows(spark, f"{tmp_dir}/b", target, ["ts"])
    assert {r.k: r[warehouse.REASONS] for r in flagged.collect()} == {"a": ["ts:missing"], "b": ["ts:type"], "c": []}
    assert warehouse.apply_policy(flagged, "skip_row").count() == 1


def test_quoted_fields(spark, tmp_dir):
    _summary(f"{tmp_dir}/q", "q.csv", ['"he said ""hi, you""",1', '" lead",2', '"two\nlines",3'])
    got = {r.feature_used: r.usage_count for r in warehouse.load_csv(spark, f"{tmp_dir}/q", SUMMARY, multiline=True).collect()}
    assert got == {'he said "hi, you"': 1, " lead": 2, "two\nlines": 3}


def test_one_busy_user_and_day_spreads_over_tasks(spark):
    busy = F.col("id") % 3 == 0
    df = spark.range(0, 9000, numPartitions=6).select(
        F.when(busy, F.lit("u")).otherwise(F.col("id").cast("string")).alias("user_id"),
        F.when(busy, F.lit("2024-01-01")).otherwise(F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))).cast("date").alias("date"),
    )
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        per_task = warehouse.cluster_fact_events(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(key, "true")
    assert max(r["count"] for r in per_task) < 2 * 9000 / 8


def test_scratch_folder_needs_a_shared_path_on_a_cluster(monkeypatch):
    from usagelens import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_discovered_platforms(spark):
    from usagelens.operators import users

    rows = [("u", dt.date(2024, 1, 1), 5, "f", "c", p) for p in ("web", "tablet", None, "tablet")]
    df = spark.createDataFrame(rows, "user_id string, date date, session_length long, feature_used string, category_used string, platform string")
    row = users.user_features(df, None).first()
    assert row.platform_tablet_count == 2 and row.platform_web_count == 1
