import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"
FAST = [
    "events_normalized", "dau", "wau_orders", "wau_iso_orders", "wau_week_start_orders", "top_features_n_orders",
    "feature_usage_over_time", "user_features", "user_features_orders", "churn_labels", "users_merged",
    "reconcile_discrepancies", "reconcile_summary", "weekly_retention_orders", "check_length", "classification_report",
    "check_not_null", "check_primary_key", "load_skip_bad_files", "load_skip_bad_rows", "load_report", "load_into_table_once",
    "load_large_counts", "load_quoted_text", "events_dropna", "enrich_category_duplicates", "count_corrupt_records",
    "user_features_discovered", "user_recency_from_text", "churn_summary_rule", "segment_engagement_rule",
    "feature_by_segment_rule", "at_risk_users", "dim_users_filled", "view_user_profile_filled",
    "load_versions", "rejected_records", "count_corrupt_array_records", "decimal_overflow", "sink_csv_ordered",
    "view_event_history_last_days", "view_event_history_busy_days", "view_feature_usage_last_days",
]


def test_every_oracle_key_has_a_query():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


def test_registry_needs_no_session():
    """Queries and SQL can be listed before any session exists."""
    code = "import __spark_entry__ as E; print(len(E.queries()) >= len(E.oracle_sql()) >= 60)"
    root = os.path.dirname(os.path.abspath(E.__file__))
    seen = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert seen.stdout.strip() == "True", seen.stderr


def test_entry_without_the_optional_folder(tmp_path):
    """Without the training-data subpackage and the pipeline the other queries are still there; another missing module is an error."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(root, "usagelens"), tmp_path / "usagelens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as E; print(len(E.queries()) > 90, any(k.startswith('op') or k == 'pipeline' for k in E.queries()))"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    seen = run()
    assert seen.stdout.split() == ["True", "False"], seen.stderr
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    assert "no_such_module" in run().stderr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "user_id"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", FAST)
def test_matches_duckdb(spark, duck, key):
    df = E.queries()[key](spark, SF)
    rel = duck.sql(E.oracle_sql()[key])
    sc, sv = canon(df.columns, [tuple(r) for r in df.collect()])
    dc, dv = canon(rel.columns, rel.fetchall())
    assert sc == dc
    assert sv == dv
