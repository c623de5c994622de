"""Plan-shape checks: the physical plans are the ones designed for scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _no_cached_plans(spark):
    # Earlier tests may have cached identical plans; cached scans change the plan text.
    spark.catalog.clearCache()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_carries_only_partials(text: str) -> bool:
    """Every single-partition exchange feeds a global aggregate of per-task
    partial results (one row per task), never raw rows."""
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            nxt = lines[i + 1] if i + 1 < len(lines) else ""
            if not ("keys=[]" in nxt and "partial_" in nxt):
                return False
    return True


@pytest.mark.parametrize(
    "key",
    ["dau", "wau_orders", "top_features", "feature_usage_over_time", "user_features_orders", "churn_labels",
     "users_merged", "reconcile_discrepancies", "weekly_retention_orders", "view_feature_usage_trends"],
)
def test_no_cartesian_or_single_partition(spark, key):
    text = _plan(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if key != "weekly_retention_orders":  # its last window runs over the small (cohort, offset) table
        assert _single_partition_carries_only_partials(text)


def test_scan_is_pruned_and_filtered(spark):
    text = E.queries()["dau"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text or "ts:timestamp_ntz,user_id:bigint" in text
    assert "props" not in text  # the catalog lookup is pruned away when not needed


def test_user_table_has_one_exchange(spark):
    text = _plan(E.queries()["user_features_orders"](spark, SF))
    assert text.count("Exchange") == 1 and "Expand" not in text
    assert "Expand" in _plan(E.queries()["user_features_expand"](spark, SF))


def test_merge_adds_no_exchange_over_the_aggregates(spark):
    text = _plan(E.queries()["users_merged"](spark, SF))
    # one hash exchange per aggregate side; the join reuses their partitioning
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2


def test_feature_by_segment_aggregates_before_join(spark):
    from usagelens.operators.kpis import feature_by_segment
    from usagelens.plans.q_etl import facts

    fx = facts(spark, SF, "orders")
    seg = fx.select("user_id").distinct().selectExpr("user_id", "'s' AS Segment")
    lines = _plan(feature_by_segment(fx, seg)).splitlines()
    join_at = next(i for i, ln in enumerate(lines) if "Join" in ln)
    below = "\n".join(lines[join_at:])
    assert any("Aggregate" in ln and "feature_used" in ln and "user_id" in ln for ln in below.splitlines())


def _scan_of(df, table: str) -> str:
    """The line of the plan that scans a stored table, told by one of its columns."""
    return next(ln for ln in _plan(df).splitlines() if "FileScan" in ln and f"{table}#" in ln)


def test_views_read_stored_tables_only(spark):
    for key in ("view_dau", "view_wau", "view_feature_usage_trends", "view_event_history"):
        read = E.queries()[key](spark, SF).inputFiles()
        assert read and all("/usagelens-store-" in f and f.endswith(".parquet") for f in read)


def test_date_range_prunes_folders_and_columns(spark):
    scan = _scan_of(E.queries()["view_event_history_last_days"](spark, SF), "session_length_sec")
    assert "PartitionFilters: [isnotnull(date" in scan and "date" in scan.split("PartitionFilters")[1].split("]")[0]
    schema = scan.split("ReadSchema: ")[1]
    assert "user_id" in schema and "timestamp" not in schema and "week" not in schema
    scan = _scan_of(E.queries()["view_feature_usage_last_days"](spark, SF), "daily_usage_count")
    assert "month" in scan.split("PartitionFilters: ")[1].split("]")[0]


def test_chosen_days_prune_folders_at_run_time(spark):
    df = E.queries()["view_event_history_busy_days"](spark, SF)
    assert "dynamicpruning" in _scan_of(df, "session_length_sec")


def test_only_the_days_asked_for_are_read(spark, tmp_dir):
    """Files of other days are not opened: a broken one does not matter."""
    import glob

    from usagelens.plans import store
    from usagelens.plans.q_etl import facts

    tables = store.build(facts(spark, SF, "events"), tmp_dir, ("fact_events", "daily_active_users"))
    days = [r.activity_date for r in tables.table("daily_active_users").orderBy("activity_date").collect()]
    for f in glob.glob(f"{tmp_dir}/fact_events/date={days[-1]}/*.parquet"):
        with open(f, "r+b") as fh:
            fh.truncate(10)
    assert tables.days("fact_events", days[0], days[-2]).select("user_id").collect()
    daily = tables.table("daily_active_users")
    last = daily.where(F.col("activity_date") == days[-1]).first().daily_active_users
    chosen = daily.where(F.col("daily_active_users") != last).withColumnRenamed("activity_date", "date")
    got = {r.date for r in tables.on_days("fact_events", chosen).select("date").distinct().collect()}
    assert got and got == {r.date for r in chosen.collect()} and days[-1] not in got


def test_stored_facts_keep_rows_without_a_date(spark, tmp_dir):
    from usagelens.plans import store
    from usagelens.plans.q_etl import facts

    fx = facts(spark, SF, "events")
    undated = fx.limit(3).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" if c in ("date", "week", "year", "timestamp") else c for c, t in fx.dtypes])
    tables = store.build(fx.unionByName(undated), tmp_dir)
    rows = tables.table("fact_events")
    assert rows.count() == fx.count() + 3 and rows.where("date IS NULL").count() == 3
    assert tables.table("daily_active_users").count() == fx.select("date").distinct().count()
    assert rows.columns[-1] == "date" and tables.table("feature_usage").where("month IS NULL").count() == 0
