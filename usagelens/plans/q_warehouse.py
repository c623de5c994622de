"""Registered queries: CSV sinks, warehouse loads, constraints, dashboard views."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas
from usagelens.operators import checks, ids, metrics, users
from usagelens.plans import store, views
from usagelens.plans.oracle_sql import churn_users_cte, facts_cte
from usagelens.plans.q_etl import facts
from usagelens.plans.registry import register
from usagelens.session import scratch_path
from usagelens.sources import adapters, files, ledger, storage, warehouse

FACT_FILE_COLUMNS = [f.name for f in schemas.FACT_EVENTS_FILE.fields]
FACT_RENAME = {"session_length": "session_length_sec"}
FACT_TARGET_COLUMNS = [FACT_RENAME.get(c, c) for c in FACT_FILE_COLUMNS]
ROW_ORDER = ["timestamp", "user_id", "category_used", "feature_used", "session_length_sec", "platform"]


def _to_csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    files.write_csv(df, path)
    return path


def load_fact_events(spark: SparkSession, path: str, policy: str = "skip_file") -> DataFrame:
    """Fact CSV -> FACT_EVENTS columns (generated id omitted), checked."""
    return warehouse.load_with_columns(
        spark,
        path,
        FACT_FILE_COLUMNS,
        schemas.FACT_EVENTS,
        FACT_RENAME,
        policy=policy,
        not_null=schemas.NOT_NULL["FACT_EVENTS"],
        max_len=schemas.LENGTH_LIMITS["FACT_EVENTS"],
    )


def fact_table(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """The transformed fact file written as CSV and loaded as FACT_EVENTS rows."""
    return load_fact_events(spark, _to_csv(spark, facts(spark, sf_dir, source), "fact-events"))


def daily_table(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    path = _to_csv(spark, metrics.dau(facts(spark, sf_dir, source)), "metrics-dau")
    return warehouse.load_csv(spark, path, schemas.FACT_DAILY_ACTIVE_USERS)


def weekly_table(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """The 3-column WAU file is loaded into its 3 columns; ``week_start_date`` is derived."""
    path = _to_csv(spark, metrics.wau(facts(spark, sf_dir, source)), "metrics-wau")
    three = T.StructType(schemas.FACT_WEEKLY_ACTIVE_USERS.fields[:3])
    return metrics.with_week_start(warehouse.load_csv(spark, path, three))


def usage_table(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    path = _to_csv(spark, metrics.feature_usage_over_time(facts(spark, sf_dir, source)), "metrics-usage")
    return warehouse.load_csv(
        spark, path, schemas.FACT_FEATURE_USAGE, max_len=schemas.LENGTH_LIMITS["FACT_FEATURE_USAGE"]
    )


def summary_table(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    path = _to_csv(spark, metrics.top_features(facts(spark, sf_dir, source)), "metrics-top")
    return warehouse.load_csv(
        spark, path, schemas.FACT_FEATURE_SUMMARY, max_len=schemas.LENGTH_LIMITS["FACT_FEATURE_SUMMARY"]
    )


def deterministic_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User rows without model outputs (features + last login + days since)."""
    u = users.churn_users(facts(spark, sf_dir, "orders"), adapters.ORDERS_PLATFORMS, adapters.ORDERS_CHURN_DAYS)
    return u.drop("churn_status")


def dim_users_table(spark: SparkSession, users_df: DataFrame, platforms: list[str]) -> DataFrame:
    """Users -> CSV in DIM_USERS column order -> positional, typed, checked load."""
    target = warehouse.dim_users_schema(platforms)
    ordered = users_df.select(
        *[F.col(f.name) if f.name in users_df.columns else F.lit(None).cast("string").alias(f.name) for f in target.fields]
    )
    path = _to_csv(spark, ordered, "dim-users")
    return warehouse.load_csv(spark, path, target, max_len=schemas.LENGTH_LIMITS["DIM_USERS"])


# ---- SQL twins ------------------------------------------------------------------

_FACT_SQL = f"""WITH {facts_cte('events')}
SELECT user_id, "timestamp", category_used, feature_used, CAST(session_length AS BIGINT) AS session_length_sec,
       platform, "date", week, "year" FROM facts"""

_DAU_SQL = f"""WITH {facts_cte('events')}
SELECT "date" AS activity_date, CAST(count(DISTINCT user_id) AS BIGINT) AS daily_active_users
FROM facts WHERE "date" IS NOT NULL GROUP BY "date" """

_WEEK_START = """CAST(make_date("year", 1, 1) + CAST((week - 1) * 7 - (isodow(make_date("year", 1, 1)) - 1) AS INTEGER) AS DATE)"""

_WAU_SQL = f"""WITH {facts_cte('orders')},
w AS (SELECT "year", week, CAST(count(DISTINCT user_id) AS BIGINT) AS weekly_active_users FROM facts
      WHERE "year" IS NOT NULL AND week IS NOT NULL GROUP BY "year", week)
SELECT "year", week, weekly_active_users, {_WEEK_START} AS week_start_date FROM w"""

_USAGE_SQL = f"""WITH {facts_cte('events')}
SELECT "date", feature_used AS feature_name, CAST(count(feature_used) AS BIGINT) AS daily_usage_count
FROM facts WHERE "date" IS NOT NULL AND feature_used IS NOT NULL GROUP BY "date", feature_used"""

_SUMMARY_SQL = f"""WITH {facts_cte('events')}
SELECT feature_used, CAST(count(*) AS BIGINT) AS usage_count
FROM facts WHERE feature_used IS NOT NULL GROUP BY feature_used"""


def _dim_sql(select_extra: str = "") -> str:
    plats = ", ".join(
        f"CAST(platform_{p}_count AS BIGINT) AS platform_{p}_count" for p in adapters.ORDERS_PLATFORMS
    )
    return f"""WITH {facts_cte('orders')}, {churn_users_cte('orders', adapters.ORDERS_CHURN_DAYS)}
SELECT user_id, CAST(NULL AS VARCHAR) AS "Segment",
  CAST(CAST(average_session_length_minutes AS VARCHAR) AS DECIMAL(10,2)) AS average_session_length_minutes,
  CAST(NULL AS DECIMAL(5,4)) AS churn_probability,
  CAST(days_since_last_login AS INTEGER) AS days_since_last_login, last_login_date,
  CAST(login_frequency AS DECIMAL(10,2)) AS login_frequency, {plats},
  CAST(NULL AS BOOLEAN) AS predicted_churn, CAST(total_events AS BIGINT) AS total_events,
  CAST(total_session_length_minutes AS DECIMAL(10,2)) AS total_session_length_minutes,
  CAST(unique_categories_used AS BIGINT) AS unique_categories_used,
  CAST(unique_features_used AS BIGINT) AS unique_features_used{select_extra}
FROM users"""


# ---- planted faults: bad rows by rule, so that loads and checks have something to find ----

# (condition on day of month d and session length s, file column, bad text, reason); SQL and Spark share the rule.
_FAULTS = [
    ("d % 5 = 0 AND s % 10 = 0", "session_length", "'n/a'", "session_length:type"),
    ("d % 5 = 0 AND s % 10 = 5", "session_length", "'12.7'", "session_length:type"),
    ("d % 5 = 1 AND s % 10 = 6", "session_length", "'99999999999999999999.0'", "session_length:overflow"),
    ("d % 5 = 1 AND s % 10 = 1", "feature_used", "repeat('x', 101)", "feature_used:length"),
    ("d % 5 = 2 AND s % 10 = 2", "user_id", "CAST(NULL AS STRING)", "user_id:missing"),
    ("d % 5 = 3 AND s % 10 = 3", "timestamp", "'not a time'", "timestamp:type"),
    ("d % 5 = 3 AND s % 10 = 4", "timestamp", "'  '", "timestamp:missing"),
]
_FAULT_SQL = "CASE " + " ".join(f"WHEN {rule} THEN '{reason}'" for rule, _, _, reason in _FAULTS) + " END"
_PLANTED_CTE = f"""{facts_cte('events')},
planted AS (SELECT *, {_FAULT_SQL} AS reason FROM (SELECT *, day("date") AS d, session_length AS s FROM facts))"""


def planted_files(spark: SparkSession, sf_dir: str) -> str:
    """Fact rows as CSV text with faults planted by ``_FAULTS``; one file a day (folder ``part``)."""
    text = facts(spark, sf_dir, "events").selectExpr("*", "day(date) AS d", "session_length AS s")
    text = text.withColumn("timestamp", F.date_format("timestamp", files.TS_FORMAT)).withColumn("session_length", F.col("session_length").cast("string"))
    for rule, column, value, _ in _FAULTS:
        text = text.withColumn(column, F.expr(f"CASE WHEN {rule} THEN {value} ELSE `{column}` END"))
    path = scratch_path(spark, "planted")
    text = text.select(*FACT_FILE_COLUMNS, F.col("date").cast("string").alias("part"))
    files.write_csv(text.repartition("part"), path, partition_by=["part"])
    return path


def planted_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planted files as typed rows with their reasons."""
    layout, required, limits = warehouse.file_layout(
        FACT_FILE_COLUMNS, schemas.FACT_EVENTS, FACT_RENAME, schemas.NOT_NULL["FACT_EVENTS"], schemas.LENGTH_LIMITS["FACT_EVENTS"]
    )
    return warehouse.flagged_rows(spark, planted_files(spark, sf_dir), layout, required, limits)


# ---- sinks ----------------------------------------------------------------------


@register(
    "sink_csv_roundtrip",
    f"""WITH {facts_cte('events')}
SELECT "date", feature_used, count(feature_used) AS usage_count FROM facts
WHERE "date" IS NOT NULL AND feature_used IS NOT NULL GROUP BY "date", feature_used""",
)
def q_sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store step: fact file + 4 metric files as CSV (one folder each); read one back."""
    fx = facts(spark, sf_dir, "events").persist()
    base = scratch_path(spark, "store")
    outputs = {
        "fact_events_transformed": fx,
        "metrics_dau": metrics.dau(fx),
        "metrics_wau": metrics.wau(fx),
        "metrics_top_features": metrics.top_features(fx),
        "metrics_feature_usage_over_time": metrics.feature_usage_over_time(fx),
    }
    for name, df in outputs.items():
        files.write_csv(df, f"{base}/{name}")
    fx.unpersist()
    schema = T.StructType(
        [
            T.StructField("date", T.DateType()),
            T.StructField("feature_used", T.StringType()),
            T.StructField("usage_count", T.LongType()),
        ]
    )
    return files.read_csv(spark, f"{base}/metrics_feature_usage_over_time", schema)


@register(
    "sink_csv_ordered",
    f"""WITH {facts_cte('events')},
n AS (SELECT 'metrics_dau' AS file, count(DISTINCT "date") AS n FROM facts
      UNION ALL SELECT 'metrics_wau', count(DISTINCT "year" * 100 + week) FROM facts
      UNION ALL SELECT 'metrics_top_features', count(DISTINCT feature_used) FROM facts
      UNION ALL SELECT 'metrics_feature_usage_over_time', count(*) FROM (SELECT DISTINCT "date", feature_used FROM facts WHERE "date" IS NOT NULL AND feature_used IS NOT NULL))
SELECT file, n AS "rows", CAST(0 AS BIGINT) AS out_of_order FROM n
UNION ALL SELECT 'metrics_dau_backwards', n, n - 1 FROM n WHERE file = 'metrics_dau'""",
)
def q_sink_csv_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric files written in the order of their keys (top features by count), read back file by file and line by
    line; and the daily file written backwards, in which every row but the first is out of order."""
    fx = facts(spark, sf_dir, "events")
    base = scratch_path(spark, "ordered")
    made = {
        "metrics_dau": (metrics.dau(fx), ["date"]),
        "metrics_wau": (metrics.wau(fx), ["year", "week"]),
        "metrics_top_features": (metrics.top_features(fx), [F.desc("usage_count"), F.asc("feature_used")]),
        "metrics_feature_usage_over_time": (metrics.feature_usage_over_time(fx), ["date", "feature_used"]),
        "metrics_dau_backwards": (metrics.dau(fx), [F.desc("date")]),
    }
    first_two = lambda a, b: F.struct(*[a[c] for c in keys]) <= F.struct(*[b[c] for c in keys])
    by_count = lambda a, b: (a["usage_count"] > b["usage_count"]) | ((a["usage_count"] == b["usage_count"]) & (a["feature_used"] <= b["feature_used"]))
    seen = []
    for name, (df, order) in made.items():
        files.write_csv_ordered(df, f"{base}/{name}", order)
        keys = [c for c in ("date", "year", "week", "feature_used") if c in df.columns]
        later = by_count if name == "metrics_top_features" else first_two
        seen.append(files.out_of_order(spark, f"{base}/{name}", df.schema, later).withColumn("file", F.lit(name)))
    return reduce(DataFrame.unionByName, seen)


# ---- loads ----------------------------------------------------------------------


@register("load_positional", _DAU_SQL)
def q_load_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_table(spark, sf_dir)


@register("load_feature_usage", _USAGE_SQL)
def q_load_feature_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage_table(spark, sf_dir)


@register("load_feature_summary", _SUMMARY_SQL)
def q_load_feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_table(spark, sf_dir)


@register("load_wau", _WAU_SQL)
def q_load_wau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_table(spark, sf_dir, "orders")


@register("load_fact_events", _FACT_SQL)
def q_load_fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_table(spark, sf_dir)


_GOOD_DAYS_SQL = f"""WITH {_PLANTED_CTE}
SELECT user_id, "timestamp", category_used, feature_used, session_length AS session_length_sec, platform, "date", week, "year"
FROM planted WHERE "date" NOT IN (SELECT "date" FROM planted WHERE reason IS NOT NULL)"""


@register("load_skip_bad_files", _GOOD_DAYS_SQL)
def q_load_skip_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file a day, some with planted bad rows: the skip-file policy drops those days whole."""
    return load_fact_events(spark, planted_files(spark, sf_dir), policy="skip_file")


@register(
    "load_skip_bad_rows",
    f"""WITH {_PLANTED_CTE}
SELECT user_id, "timestamp", category_used, feature_used, session_length AS session_length_sec, platform, "date", week, "year"
FROM planted WHERE reason IS NULL""",
)
def q_load_skip_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_fact_events(spark, planted_files(spark, sf_dir), policy="skip_row")


@register(
    "load_report",
    f"""WITH {_PLANTED_CTE}
SELECT strftime("date", '%Y-%m-%d') AS part, count(*) AS "rows", count(reason) AS bad_rows,
       coalesce(string_agg(DISTINCT reason, ',' ORDER BY reason), '') AS reasons,
       CASE WHEN count(reason) > 0 THEN 'skipped' ELSE 'loaded' END AS status
FROM planted GROUP BY "date" """,
)
def q_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, bad rows, reasons and fate of every file (named by its day)."""
    report = warehouse.load_report(planted_flags(spark, sf_dir))
    return report.withColumn("part", F.regexp_extract("file", "part=([^/]+)", 1)).drop("file")


_CHANGES_CTE = f"""{_PLANTED_CTE},
days AS (SELECT "date", count(reason) > 0 AS bad FROM planted GROUP BY "date"),
picked AS (SELECT min("date") FILTER (bad) AS repaired, min("date") FILTER (NOT bad) AS changed FROM days)"""


def stored_with_changes(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """The planted files loaded into a stored table; then one rejected file is repaired and one loaded file loses
    some rows, both under their old names; loaded again, and a third time with nothing changed."""
    path, table = planted_files(spark, sf_dir), scratch_path(spark, "stored-fact-events")
    layout, required, limits = warehouse.file_layout(
        FACT_FILE_COLUMNS, schemas.FACT_EVENTS, FACT_RENAME, schemas.NOT_NULL["FACT_EVENTS"], schemas.LENGTH_LIMITS["FACT_EVENTS"]
    )
    load = lambda: ledger.load_new(spark, path, table, layout, required, limits)
    day = F.regexp_extract("file", "part=([^/]+)", 1)
    first = load().withColumn("day", day)
    names = {r["path"].rsplit("part=", 1)[1][:10]: r["path"] for r in ledger.file_versions(spark, path).select("path").collect()}  # one file a day
    repaired, changed = first.agg(F.min(F.when(F.col("bad_rows") > 0, F.col("day"))), F.min(F.when(F.col("bad_rows") == 0, F.col("day")))).first()
    rows = facts(spark, sf_dir, "events").select(*FACT_FILE_COLUMNS)
    of_day = lambda d: rows.where(F.col("date") == F.lit(d).cast("date"))
    if repaired:
        storage.write_csv_file(of_day(repaired), names[repaired])
    if changed:
        storage.write_csv_file(of_day(changed).where("session_length % 3 != 0"), names[changed])
    load()
    load()
    return table, layout


@register(
    "load_into_table_once",
    f"""WITH {_CHANGES_CTE}
SELECT user_id, "timestamp", category_used, feature_used, session_length AS session_length_sec, platform, planted."date", week, "year"
FROM planted JOIN days USING ("date"), picked
WHERE planted."date" = repaired OR (NOT bad AND (planted."date" <> changed OR s % 3 <> 0))""",
)
def q_load_into_table_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of the planted files into one stored table: unchanged files count once, a repaired
    file is taken in, and the rows of a changed file take the place of its old ones."""
    table, layout = stored_with_changes(spark, sf_dir)
    return ledger.read_table(spark, table, layout).withColumnsRenamed(FACT_RENAME)


@register(
    "load_versions",
    f"""WITH {_CHANGES_CTE},
n AS (SELECT "date", count(*) AS n, count(reason) AS b, count_if(s % 3 <> 0) AS kept FROM planted GROUP BY "date"),
looked AS (
  SELECT 1 AS load_no, CASE WHEN bad THEN 'skipped' ELSE 'loaded' END AS status, n, b FROM n JOIN days USING ("date")
  UNION ALL SELECT 2, CASE WHEN bad AND "date" <> repaired THEN 'skipped' ELSE 'loaded' END,
                   CASE WHEN "date" = changed THEN kept ELSE n END, CASE WHEN "date" = repaired THEN 0 ELSE b END
            FROM n JOIN days USING ("date"), picked WHERE bad OR "date" = changed
  UNION ALL SELECT 3, 'skipped', n, b FROM n JOIN days USING ("date"), picked WHERE bad AND "date" <> repaired)
SELECT CAST(load_no AS BIGINT) AS load_no, status, count(*) AS files, CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(b) AS BIGINT) AS bad_rows
FROM looked GROUP BY load_no, status""",
)
def q_load_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the three loads looked at: rejected files every time, loaded ones only when changed."""
    seen = ledger.history(spark, stored_with_changes(spark, sf_dir)[0])
    return seen.groupBy("load_no", "status").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"))


_SCALE = 1_000_000_000


@register(
    "load_large_counts",
    f"""WITH {facts_cte('events')}
SELECT feature_used, count(*) * CAST({_SCALE} AS BIGINT) AS usage_count FROM facts WHERE feature_used IS NOT NULL GROUP BY feature_used""",
)
def q_load_large_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature counts above the 32-bit range."""
    top = metrics.top_features(facts(spark, sf_dir, "events"))
    path = _to_csv(spark, top.withColumn("usage_count", F.col("usage_count") * F.lit(_SCALE)), "large-counts")
    return warehouse.load_csv(spark, path, schemas.FACT_FEATURE_SUMMARY)


@register(
    "load_quoted_text",
    f"""WITH {facts_cte('events')}
SELECT ' "' || feature_used || '", a' || chr(10) || '""line ' AS feature_used, count(*) AS usage_count
FROM facts WHERE feature_used IS NOT NULL GROUP BY feature_used""",
)
def q_load_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas, line breaks and blanks at both ends survive write and load."""
    top = metrics.top_features(facts(spark, sf_dir, "events"))
    odd = top.withColumn("feature_used", F.concat(F.lit(' "'), "feature_used", F.lit('", a\n""line ')))
    return warehouse.load_csv(spark, _to_csv(spark, odd, "quoted"), schemas.FACT_FEATURE_SUMMARY, multiline=True)


@register("fact_events_clustered", _FACT_SQL)
def q_fact_events_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FACT_EVENTS stored clustered by day then user (day folders, user-sorted files)."""
    path = scratch_path(spark, "fact-clustered")
    warehouse.save_table(warehouse.cluster_fact_events(fact_table(spark, sf_dir)), path, ["date"])
    return spark.read.parquet(path).select(*FACT_TARGET_COLUMNS)


@register(
    "fact_events_row_id",
    f"""WITH f AS ({_FACT_SQL})
SELECT row_number() OVER (ORDER BY {', '.join(f'"{c}" NULLS FIRST' for c in ROW_ORDER)}) AS event_id, * FROM f""",
)
def q_fact_events_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.with_dense_id(fact_table(spark, sf_dir), ROW_ORDER, "event_id")


@register("dim_users_typed", _dim_sql())
def q_dim_users_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_users_table(spark, deterministic_users(spark, sf_dir), adapters.ORDERS_PLATFORMS)


_OVERFLOW_SQL = f"""WITH {facts_cte('orders')}, {churn_users_cte('orders', adapters.ORDERS_CHURN_DAYS)},
big AS (SELECT *, total_session_length_minutes * CASE WHEN total_events % 3 = 0 THEN 1e9 ELSE 1 END AS total FROM users)"""


def _overflowing_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User rows; of every third (by events) the total is a thousand million times as large, too much for its column."""
    total = F.col("total_session_length_minutes") * F.when(F.col("total_events") % 3 == 0, F.lit(1e9)).otherwise(F.lit(1.0))
    return deterministic_users(spark, sf_dir).withColumn("total_session_length_minutes", total)


@register(
    "decimal_overflow",
    f"""{_OVERFLOW_SQL}
SELECT 'cast' AS step, 'total_session_length_minutes' AS reasons, CAST(count_if(abs(total) >= 99999999.995) AS BIGINT) AS "rows" FROM big
UNION ALL SELECT 'load', 'total_session_length_minutes:overflow', CAST(count_if(abs(total) >= 99999999.995) AS BIGINT) FROM big
UNION ALL SELECT 'load', '', CAST(count_if(abs(total) < 99999999.995) AS BIGINT) FROM big""",
)
def q_decimal_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals beyond DECIMAL(10,2): counted by the typed cast, and a reason of their own when loaded from CSV."""
    rows, target = _overflowing_users(spark, sf_dir), warehouse.dim_users_schema(adapters.ORDERS_PLATFORMS)
    lost = warehouse.cast_losses(rows, target).where("lost > 0 OR column_name = 'total_session_length_minutes'")
    lost = lost.select(F.lit("cast").alias("step"), F.col("column_name").alias("reasons"), F.col("lost").alias("rows"))
    text = rows.select(*[F.col(f.name).cast("string") if f.name in rows.columns else F.lit(None).cast("string").alias(f.name) for f in target.fields])
    flagged = warehouse.flagged_rows(spark, _to_csv(spark, text, "overflowing-users"), target)
    why = F.array_join(warehouse.REASONS, ",")
    return lost.unionByName(flagged.groupBy(why.alias("reasons")).agg(F.count(F.lit(1)).alias("rows")).withColumn("step", F.lit("load")))


# ---- constraints ----------------------------------------------------------------


def planted_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User keys and segments with faults by rule: null keys, duplicates, over-long keys and segments."""
    c = adapters.read_table(spark, sf_dir, "orders").select("o_custkey").distinct()
    key = F.col("o_custkey").cast("string")
    segment = F.when(F.col("o_custkey") % 83 == 0, F.repeat(F.lit("s"), 51)).otherwise("segment")
    first = c.select(F.when(F.col("o_custkey") % 89 != 0, key).alias("user_id"), segment.alias("Segment"), "o_custkey")
    again = c.where("o_custkey % 97 = 0").select(key.alias("user_id"), segment.alias("Segment"), "o_custkey")
    return first.unionByName(again)


@register(
    "check_primary_key",
    f"""WITH {facts_cte('events')},
d AS (SELECT "date" AS k, count(DISTINCT user_id) AS n FROM facts WHERE "date" IS NOT NULL GROUP BY 1),
s AS (SELECT feature_used AS k, count(*) AS n FROM facts WHERE feature_used IS NOT NULL GROUP BY 1),
c AS (SELECT DISTINCT o_custkey FROM orders),
u AS (SELECT CASE WHEN o_custkey % 89 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS k FROM c
      UNION ALL SELECT CAST(o_custkey AS VARCHAR) FROM c WHERE o_custkey % 97 = 0)
SELECT 'FACT_DAILY_ACTIVE_USERS' AS table_name, 'activity_date' AS key_columns, CAST(count(*) AS BIGINT) AS "rows",
       count(DISTINCT k) AS distinct_keys, CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS null_keys FROM d
UNION ALL
SELECT 'FACT_FEATURE_SUMMARY', 'feature_used', CAST(count(*) AS BIGINT), count(DISTINCT k), CAST(0 AS BIGINT),
       CAST(0 AS BIGINT) FROM s
UNION ALL
SELECT 'DIM_USERS', 'user_id', CAST(count(*) AS BIGINT), (SELECT count(*) FROM (SELECT DISTINCT k FROM u)),
       (SELECT count(*) FROM (SELECT k FROM u GROUP BY k HAVING count(*) > 1)), CAST(count_if(k IS NULL) AS BIGINT) FROM u
UNION ALL
SELECT 'FACT_EVENTS', 'user_id,date', CAST(count(*) AS BIGINT),
       (SELECT count(*) FROM (SELECT DISTINCT user_id, "date" FROM facts)),
       (SELECT count(*) FROM (SELECT user_id, "date" FROM facts GROUP BY ALL HAVING count(*) > 1)),
       CAST(count_if(user_id IS NULL OR "date" IS NULL) AS BIGINT) FROM facts""",
)
def q_check_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared keys of the loaded tables, of user rows with planted duplicates and
    null keys, and (user_id, date) on the fact rows (users act many times a day)."""
    reports = [
        checks.primary_key_report(daily_table(spark, sf_dir), ["activity_date"], "FACT_DAILY_ACTIVE_USERS"),
        checks.primary_key_report(summary_table(spark, sf_dir), ["feature_used"], "FACT_FEATURE_SUMMARY"),
        checks.primary_key_report(planted_users(spark, sf_dir), ["user_id"], "DIM_USERS"),
        checks.primary_key_report(facts(spark, sf_dir, "events"), ["user_id", "date"], "FACT_EVENTS"),
    ]
    return reduce(DataFrame.unionByName, reports)


@register(
    "check_not_null",
    f"""WITH {_PLANTED_CTE}
SELECT 'FACT_EVENTS' AS table_name, 'user_id' AS column_name, CAST(count_if(reason = 'user_id:missing') AS BIGINT) AS violations
FROM planted
UNION ALL SELECT 'FACT_EVENTS', 'timestamp', CAST(count_if(reason LIKE 'timestamp:%') AS BIGINT) FROM planted""",
)
def q_check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns of the planted rows, after typing (a bad timestamp is a missing one)."""
    return checks.not_null_report(planted_flags(spark, sf_dir), schemas.NOT_NULL["FACT_EVENTS"], "FACT_EVENTS")


@register(
    "check_length",
    f"""WITH {_PLANTED_CTE},
c AS (SELECT DISTINCT o_custkey FROM orders),
u AS (SELECT o_custkey FROM c UNION ALL SELECT o_custkey FROM c WHERE o_custkey % 97 = 0),
f AS (SELECT DISTINCT feature_used FROM facts WHERE feature_used IS NOT NULL),
x AS (SELECT count_if(feature_used LIKE '%4') AS v FROM f)
SELECT table_name, column_name, CAST(violations AS BIGINT) AS violations, CAST(max_length AS INTEGER) AS max_length FROM (
  SELECT 'FACT_EVENTS' AS table_name, 'user_id' AS column_name, 0 AS violations, 36 AS max_length
  UNION ALL SELECT 'FACT_EVENTS', 'category_used', 0, 50
  UNION ALL SELECT 'FACT_EVENTS', 'feature_used', (SELECT count_if(reason = 'feature_used:length') FROM planted), 100
  UNION ALL SELECT 'FACT_EVENTS', 'platform', 0, 20
  UNION ALL SELECT 'DIM_USERS', 'user_id', (SELECT count_if(o_custkey % 79 = 0) FROM u), 36
  UNION ALL SELECT 'DIM_USERS', 'Segment', (SELECT count_if(o_custkey % 83 = 0) FROM u), 50
  UNION ALL SELECT 'FACT_FEATURE_USAGE', 'feature_name', (SELECT v FROM x), 100
  UNION ALL SELECT 'FACT_FEATURE_SUMMARY', 'feature_used', (SELECT v FROM x), 100)""",
)
def q_check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared string limits, over rows in which some values are planted too long."""
    limits = schemas.LENGTH_LIMITS
    long_key = F.when(F.col("o_custkey") % 79 == 0, F.repeat(F.lit("u"), 37)).otherwise(F.col("user_id"))
    names = facts(spark, sf_dir, "events").select("feature_used").distinct().where("feature_used IS NOT NULL")
    names = names.select(F.when(F.col("feature_used").endswith("4"), F.repeat("feature_used", 12)).otherwise(F.col("feature_used")).alias("feature_used"))
    reports = [
        checks.length_report(planted_flags(spark, sf_dir), limits["FACT_EVENTS"], "FACT_EVENTS"),
        checks.length_report(planted_users(spark, sf_dir).withColumn("user_id", long_key), limits["DIM_USERS"], "DIM_USERS"),
        checks.length_report(names.withColumnRenamed("feature_used", "feature_name"), limits["FACT_FEATURE_USAGE"], "FACT_FEATURE_USAGE"),
        checks.length_report(names, limits["FACT_FEATURE_SUMMARY"], "FACT_FEATURE_SUMMARY"),
    ]
    return reduce(DataFrame.unionByName, reports)


# ---- dashboard views --------------------------------------------------------------


def event_store(spark: SparkSession, sf_dir: str) -> store.Store:
    return store.opened(spark, f"{sf_dir}#events", lambda: facts(spark, sf_dir, "events"))


@register("view_dau", _DAU_SQL)
def q_view_dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.daily_active_users(event_store(spark, sf_dir).table("daily_active_users"))


@register("view_wau", _WAU_SQL)
def q_view_wau(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = store.opened(spark, f"{sf_dir}#orders", lambda: facts(spark, sf_dir, "orders"), ("weekly_active_users",))
    return views.weekly_active_users(weekly.table("weekly_active_users"))


_TRENDS_CTE = f"""{facts_cte('events')},
fu AS (SELECT "date", feature_used AS feature_name, CAST(count(feature_used) AS BIGINT) AS daily_usage_count
       FROM facts WHERE "date" IS NOT NULL AND feature_used IS NOT NULL GROUP BY 1, 2),
fs AS (SELECT feature_used, CAST(count(*) AS BIGINT) AS usage_count FROM facts
       WHERE feature_used IS NOT NULL GROUP BY 1)"""


@register(
    "view_feature_usage_trends",
    f"""WITH {_TRENDS_CTE}
SELECT fu."date", fu.feature_name, fu.daily_usage_count, fs.usage_count AS total_usage_count
FROM fu LEFT JOIN fs ON fu.feature_name = fs.feature_used""",
)
def q_view_feature_usage_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = event_store(spark, sf_dir)
    return views.feature_usage_trends(tables.table("feature_usage"), tables.table("feature_summary"))


@register(
    "view_event_history",
    f"""WITH f AS ({_FACT_SQL}) SELECT user_id, "date", category_used, feature_used, platform, session_length_sec FROM f""",
)
def q_view_event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.event_history(event_store(spark, sf_dir).table("fact_events"))


_LAST_DAYS = 7


def _last_days(tables: store.Store) -> tuple:
    """First and last of the last days on record, from the daily summary (one row)."""
    last = tables.table("daily_active_users").agg(F.max("activity_date")).first()[0] or dt.date(1970, 1, 1)
    return last - dt.timedelta(days=_LAST_DAYS - 1), last


@register(
    "view_event_history_last_days",
    f"""WITH f AS ({_FACT_SQL}) SELECT user_id, "date", category_used, feature_used, platform, session_length_sec FROM f
WHERE "date" > (SELECT max("date") FROM f) - {_LAST_DAYS}""",
)
def q_view_event_history_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event history of the last seven days: the other days' folders are pruned when the query is planned."""
    tables = event_store(spark, sf_dir)
    return views.event_history(tables.days("fact_events", *_last_days(tables)))


@register(
    "view_event_history_busy_days",
    f"""WITH f AS ({_FACT_SQL}),
d AS (SELECT "date", count(DISTINCT user_id) AS n FROM f WHERE "date" IS NOT NULL GROUP BY "date")
SELECT user_id, "date", category_used, feature_used, platform, session_length_sec FROM f
WHERE "date" IN (SELECT "date" FROM d WHERE n > (SELECT avg(n) FROM d))""",
)
def q_view_event_history_busy_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event history of the days with more active users than the average day: folders are pruned as the join runs."""
    tables = event_store(spark, sf_dir)
    daily = tables.table("daily_active_users")
    mean = daily.agg(F.avg("daily_active_users").alias("mean"))
    busy = daily.where(F.col("daily_active_users") > mean.scalar()).withColumnRenamed("activity_date", "date")
    return views.event_history(tables.on_days("fact_events", busy))


@register(
    "view_feature_usage_last_days",
    f"""WITH {_TRENDS_CTE}
SELECT fu."date", fu.feature_name, fu.daily_usage_count, fs.usage_count AS total_usage_count
FROM fu LEFT JOIN fs ON fu.feature_name = fs.feature_used WHERE "date" > (SELECT max("date") FROM facts) - {_LAST_DAYS}""",
)
def q_view_feature_usage_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = event_store(spark, sf_dir)
    return views.feature_usage_trends(tables.days("feature_usage", *_last_days(tables)), tables.table("feature_summary"))


@register("view_user_profile", _dim_sql())
def q_view_user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile view over DIM_USERS loaded from deterministic user rows (model columns empty)."""
    dim = dim_users_table(spark, deterministic_users(spark, sf_dir), adapters.ORDERS_PLATFORMS)
    return views.user_profile(dim, adapters.ORDERS_PLATFORMS)


_PROJECTED = ["user_id"] + schemas.USER_FEATURE_BASE + schemas.platform_columns(adapters.ORDERS_PLATFORMS)


@register(
    "scan_csv_users_projected",
    f"""WITH {facts_cte('orders')}, {churn_users_cte('orders', adapters.ORDERS_CHURN_DAYS)}
SELECT {', '.join(_PROJECTED)} FROM users""",
)
def q_scan_csv_users_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the wide user file, read back only a column subset (the CSV parser
    skips the other fields)."""
    wide = users.churn_users(facts(spark, sf_dir, "orders"), adapters.ORDERS_PLATFORMS, adapters.ORDERS_CHURN_DAYS)
    path = _to_csv(spark, wide, "users-wide")
    return files.read_csv_projected(spark, path, wide.schema, _PROJECTED)
