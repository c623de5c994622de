"""Registered queries: reconciling user tables from two runs.

Run 1 is an earlier run that only saw activity up to a year before the last
date; run 2 sees everything and also carries recency columns.  Users active
only recently exist only in run 2; users idle for a year agree on every
common column; the rest differ in some.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.operators import reconcile, users
from usagelens.plans.oracle_sql import facts_cte, user_features_select
from usagelens.plans.q_etl import facts
from usagelens.plans.registry import register
from usagelens.session import scratch_path
from usagelens.sources import adapters, files

LOOKBACK_DAYS = 365
PLATS = adapters.ORDERS_PLATFORMS
COMMON = sorted(schemas.USER_FEATURE_BASE + schemas.platform_columns(PLATS))


def two_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    fx = facts(spark, sf_dir, "orders")
    snap = users.snapshot_date(fx)
    run1 = users.user_features(fx.where(F.col("date") <= F.date_sub(snap, LOOKBACK_DAYS)), PLATS)
    run2 = users.churn_users(fx, PLATS, adapters.ORDERS_CHURN_DAYS, snapshot=snap).drop("churn_status")
    return run1, run2


_RUNS_SQL = f"""WITH {facts_cte('orders')},
s AS (SELECT max("date") AS snap FROM facts),
r1 AS (SELECT {user_features_select('orders')} FROM facts
       WHERE user_id IS NOT NULL AND "date" <= (SELECT snap FROM s) - {LOOKBACK_DAYS} GROUP BY user_id),
r2 AS (SELECT {user_features_select('orders', ', max("date") AS last_login_date')},
              CAST(date_diff('day', max("date"), (SELECT snap FROM s)) AS INTEGER) AS days_since_last_login
       FROM facts WHERE user_id IS NOT NULL GROUP BY user_id)"""

_DIFF = " OR ".join(f"a.{c} <> b.{c}" for c in COMMON)


@register(
    "users_merged",
    f"""{_RUNS_SQL}
SELECT coalesce(a.user_id, b.user_id) AS user_id,
  {', '.join(f'coalesce(a.{c}, b.{c}) AS {c}' for c in COMMON)},
  b.last_login_date, b.days_since_last_login
FROM r1 a FULL JOIN r2 b ON a.user_id = b.user_id""",
)
def q_users_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    run1, run2 = two_runs(spark, sf_dir)
    return reconcile.merge_tables(run1, run2)


@register(
    "reconcile_discrepancies",
    f"""{_RUNS_SQL}
SELECT coalesce(a.user_id, b.user_id) AS user_id,
  {', '.join(f'CASE WHEN a.{c} <> b.{c} THEN a.{c} END AS {c}_file1, CASE WHEN a.{c} <> b.{c} THEN b.{c} END AS {c}_file2' for c in COMMON)}
FROM r1 a FULL JOIN r2 b ON a.user_id = b.user_id
WHERE {_DIFF}""",
)
def q_reconcile_discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    run1, run2 = two_runs(spark, sf_dir)
    return reconcile.discrepancies(run1, run2)


@register(
    "reconcile_summary",
    f"""{_RUNS_SQL},
c AS (SELECT
  {', '.join(f'CAST(count_if(coalesce(a.{c} <> b.{c}, false)) AS BIGINT) AS {c}' for c in COMMON)},
  CAST(count_if(a.user_id IS NOT NULL AND b.user_id IS NULL) AS BIGINT) AS users_only_in_file1,
  CAST(count_if(b.user_id IS NOT NULL AND a.user_id IS NULL) AS BIGINT) AS users_only_in_file2
  FROM r1 a FULL JOIN r2 b ON a.user_id = b.user_id)
SELECT column_name, users_differing, users_only_in_file1, users_only_in_file2
FROM c UNPIVOT (users_differing FOR column_name IN ({', '.join(COMMON)}))""",
)
def q_reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    run1, run2 = two_runs(spark, sf_dir)
    return reconcile.discrepancy_summary(run1, run2)


@register(
    "conditional_sink",
    f"""{_RUNS_SQL}
SELECT 'discrepancies' AS sink, count(*) > 0 AS written, count(*) AS "rows" FROM r1 a FULL JOIN r2 b ON a.user_id = b.user_id WHERE {_DIFF}
UNION ALL SELECT 'none', false, 0""",
)
def q_conditional_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discrepancies of two runs are written as they exist; those of a run with itself are not."""
    run1, run2 = two_runs(spark, sf_dir)
    path = scratch_path(spark, "discrepancies")
    found = reconcile.discrepancies(run1, run2)
    written = files.write_if_any(found, path)
    none = files.write_if_any(reconcile.discrepancies(run1, run1), f"{path}-none")
    out = files.read_csv(spark, path, found.schema).agg(F.count(F.lit(1)).alias("rows")) if written else spark.range(1).select(F.lit(0).cast("bigint").alias("rows"))
    first = out.select(F.lit("discrepancies").alias("sink"), F.lit(written).alias("written"), "rows")
    return first.unionByName(spark.range(1).select(F.lit("none").alias("sink"), F.lit(none).alias("written"), F.lit(0).cast("bigint").alias("rows")))
