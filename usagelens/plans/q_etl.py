"""Registered queries: log scans, normalisation, product metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas
from usagelens.operators import metrics, normalize
from usagelens.plans.oracle_sql import ACT, facts_cte
from usagelens.plans.registry import register
from usagelens.session import scratch_path
from usagelens.sources import adapters, catalog, files


def facts(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """Activity rows of a source plus date, ISO week and calendar year."""
    return normalize.add_calendar(adapters.activity(spark, sf_dir, source))


FACT_COLS = ", ".join(
    f'"{c}"' for c in ["user_id", "timestamp", "category_used", "feature_used", "session_length", "platform", "date", "week", "year"]
)


# ---- sources ----------------------------------------------------------------


@register("scan_json_events", f"WITH {facts_cte('events')} SELECT {FACT_COLS} FROM facts")
def q_scan_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write activity rows as JSON log records, read them back with the raw schema, normalise."""
    path = scratch_path(spark, "json-events")
    files.write_json_events(adapters.activity(spark, sf_dir, "events"), path)
    return normalize.events_normalized(files.read_json_events(spark, path))


@register("scan_json_array", f"WITH {facts_cte('orders')} SELECT {FACT_COLS} FROM facts")
def q_scan_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files that are JSON arrays, cut at record ends by many tasks."""
    path = scratch_path(spark, "json-arrays")
    files.write_json_array(adapters.activity(spark, sf_dir, "orders").hint("rebalance"), path)
    return normalize.events_normalized(files.read_json_events(spark, path, multiline=True))


# Fact file read back with the timestamp as text, parsed like any raw log.
_FACT_CSV_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType) for f in schemas.FACT_EVENTS_FILE.fields]
)


@register("scan_csv_events", f"WITH {facts_cte('events')} SELECT {FACT_COLS} FROM facts")
def q_scan_csv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the transformed fact file as CSV (header, no index) and read it back typed."""
    path = scratch_path(spark, "fact-csv")
    files.write_csv(facts(spark, sf_dir, "events"), path)
    raw = files.read_csv(spark, path, _FACT_CSV_SCHEMA)
    return raw.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))


@register(
    "feature_catalog_explode",
    f"""WITH act AS ({ACT['events']})
SELECT DISTINCT category_used AS category, feature_used AS feature_name
FROM act WHERE feature_used IS NOT NULL AND category_used IS NOT NULL AND category_used <> 'Unknown'""",
)
def q_feature_catalog_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog observed in the data -> nested JSON, one document a category -> read back -> flat rows."""
    observed = catalog.catalog_from_events(adapters.activity(spark, sf_dir, "events"))
    path = scratch_path(spark, "catalog")
    catalog.nest_catalog(observed).write.mode("overwrite").json(path)
    return catalog.explode_catalog(catalog.read_feature_catalog(spark, path, multiline=False))


# ---- normalisation ------------------------------------------------------------


@register("events_normalized", f"WITH {facts_cte('events')} SELECT {FACT_COLS} FROM facts")
def q_events_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir, "events")


@register(
    "events_normalized_orders", f"WITH {facts_cte('orders')} SELECT {FACT_COLS} FROM facts"
)
def q_events_normalized_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir, "orders")


@register("events_dropna", f"WITH {facts_cte('events')} SELECT {FACT_COLS} FROM facts WHERE \"timestamp\" IS NOT NULL AND session_length % 10 <> 7")
def q_events_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records of which some (by rule) have a timestamp that does not parse: those rows go."""
    act = adapters.activity(spark, sf_dir, "events")
    text = F.when(F.col("session_length") % 10 == 7, F.lit("no time")).otherwise(F.date_format("timestamp", files.TS_FORMAT))
    return normalize.drop_null_timestamps(normalize.events_normalized(act.withColumn("timestamp", text)))


@register(
    "enrich_category_duplicates",
    f"""WITH act AS ({ACT['events']})
SELECT user_id, "timestamp", feature_used,
       CASE WHEN category_used = 'Unknown' THEN 'Unknown' WHEN feature_used LIKE '%0' THEN 'first' ELSE category_used END AS category_used
FROM act""",
)
def q_enrich_category_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog that lists every feature under ``first``, then under its own category, and some under ``first`` again."""
    flat = adapters.events_catalog(spark).withColumn("position", F.lit(1))
    first = flat.withColumn("category", F.lit("first"))
    again = first.where(F.col("feature_name").endswith("0")).withColumn("position", F.lit(2))
    doubled = first.withColumn("position", F.lit(0)).unionByName(flat).unionByName(again)
    rows = adapters.activity(spark, sf_dir, "events").drop("category_used")
    return catalog.enrich_category(rows, doubled).select("user_id", "timestamp", "feature_used", "category_used")


@register(
    "count_corrupt_records",
    f"WITH act AS ({ACT['events']}) SELECT count(*) AS records, count_if(session_length % 10 IN (7, 8)) AS corrupt_records FROM act",
)
def q_count_corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON log lines of which some (by rule) are cut off or hold a wrong type, counted on reading."""
    record = F.to_json(F.struct("user_id", "feature_used", "session_length"))
    last = F.col("session_length") % 10
    line = F.when(last == 7, F.substring(record, 1, 20)).when(last == 8, F.replace(record, F.lit('"session_length":'), F.lit('"session_length":"x"')))
    path = scratch_path(spark, "corrupt-json")
    adapters.activity(spark, sf_dir, "events").select(F.coalesce(line, record).alias("value")).write.text(path)
    return files.count_corrupt_json(spark, path)


@register(
    "count_corrupt_array_records",
    f"WITH act AS ({ACT['events']}) SELECT count(*) AS records, CAST(count_if(session_length % 10 = 8) AS BIGINT) AS corrupt_records FROM act",
)
def q_count_corrupt_array_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON array logs in which some records (by rule) hold a wrong type, counted one by one."""
    act = adapters.activity(spark, sf_dir, "events")
    wrong = F.when(F.col("session_length") % 10 == 8, F.lit('x{]"}\\')).otherwise(F.col("session_length").cast("string"))
    path = scratch_path(spark, "corrupt-array")
    typed = act.select("user_id", "feature_used", F.when(F.col("session_length") % 10 != 8, F.col("session_length")).alias("session_length"))
    files.write_json_array(act.select("user_id", "feature_used", wrong.alias("session_length")).where("session_length LIKE 'x%'"), f"{path}/wrong")
    files.write_json_array(typed.where("session_length IS NOT NULL").hint("rebalance"), f"{path}/typed")
    return files.json_records(spark, [f"{path}/wrong", f"{path}/typed"], multiline=True).counts()


@register(
    "rejected_records",
    f"""WITH {facts_cte('events')}, f AS (SELECT *, session_length % 10 AS s, day("date") AS d FROM facts)
SELECT 'csv' AS format, CAST(d AS BIGINT) AS day, count(*) AS rejected FROM f WHERE s IN (3, 4) GROUP BY d
UNION ALL SELECT 'json', CAST(d AS BIGINT), count(*) FROM f WHERE s IN (7, 8) GROUP BY d""",
)
def q_rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day, read from the rejected record's own text, of CSV and JSON records planted with faults by rule: a field
    too many or a wrong type (CSV), a cut-off record or a wrong type (JSON)."""
    rows = facts(spark, sf_dir, "events").withColumn("day", F.concat(F.lit("day"), F.dayofmonth("date")))
    last = F.col("session_length") % 10
    fields = F.concat_ws(",", "user_id", "day", F.when(last == 4, F.lit("n/a")).otherwise(F.col("session_length").cast("string")))
    csv, json = scratch_path(spark, "faulty-csv"), scratch_path(spark, "faulty-json")
    rows.select(F.when(last == 3, F.concat(fields, F.lit(",more"))).otherwise(fields).alias("value")).write.text(csv)
    record = F.to_json(F.struct("day", "user_id", "session_length"))
    line = F.when(last == 7, F.concat(F.lit('{"day":"'), "day", F.lit('","user_id":'))).when(last == 8, F.replace(record, F.lit('"session_length":'), F.lit('"session_length":"x"')))
    rows.select(F.coalesce(line, record).alias("value")).write.text(json)
    schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("day", T.StringType()), T.StructField("session_length", T.LongType())])
    found = {"csv": files.csv_records(spark, csv, schema, header=False), "json": files.json_records(spark, json, schema=schema)}
    texts = [r.rejected.select(F.lit(k).alias("format"), F.regexp_extract("record", "day([0-9]+)", 1).cast("long").alias("day")) for k, r in found.items()]
    return texts[0].unionByName(texts[1]).groupBy("format", "day").agg(F.count(F.lit(1)).alias("rejected"))


@register(
    "session_clamp",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS "timestamp",
       CAST(round(value * 40) AS BIGINT) AS raw_seconds,
       CAST(least(greatest(CAST(round(value * 40) AS BIGINT), 5), 3600) AS BIGINT) AS session_length
FROM events""",
)
def q_session_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = adapters.read_table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.round(F.col("value") * adapters.EVENTS_SESSION_SCALE).cast("bigint").alias("raw_seconds"),
    )
    return normalize.clamp_sessions(ev.withColumn("session_length", F.col("raw_seconds")))


@register(
    "enrich_category",
    f"""WITH act AS ({ACT['events']})
SELECT user_id, "timestamp", feature_used, category_used FROM act""",
)
def q_enrich_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.activity(spark, sf_dir, "events").drop("category_used")
    enriched = catalog.enrich_category(rows, adapters.events_catalog(spark))
    return enriched.select("user_id", "timestamp", "feature_used", "category_used")


# ---- metrics ------------------------------------------------------------------


def _dau_sql(src: str) -> str:
    return f"""WITH {facts_cte(src)}
SELECT "date", count(DISTINCT user_id) AS active_users FROM facts WHERE "date" IS NOT NULL GROUP BY "date" """


def _wau_sql(src: str) -> str:
    return f"""WITH {facts_cte(src)}
SELECT "year", week, count(DISTINCT user_id) AS active_users FROM facts
WHERE "year" IS NOT NULL AND week IS NOT NULL GROUP BY "year", week"""


def _wau_iso_sql(src: str) -> str:
    return f"""WITH {facts_cte(src)}
SELECT CAST(isoyear("date") AS INTEGER) AS "year", CAST(week("date") AS INTEGER) AS week,
       CAST(date_trunc('week', "date") AS DATE) AS week_start_date,
       count(DISTINCT user_id) AS active_users
FROM facts WHERE "date" IS NOT NULL GROUP BY 1, 2, 3"""


def _wau_week_start_sql(src: str) -> str:
    return f"""WITH {facts_cte(src)},
w AS (SELECT "year", week, count(DISTINCT user_id) AS active_users FROM facts
      WHERE "year" IS NOT NULL AND week IS NOT NULL GROUP BY "year", week)
SELECT "year", week, active_users,
       CAST(make_date("year", 1, 1) + CAST((week - 1) * 7 - (isodow(make_date("year", 1, 1)) - 1) AS INTEGER) AS DATE)
         AS week_start_date
FROM w"""


def _top_sql(src: str, limit: str = "") -> str:
    return f"""WITH {facts_cte(src)}
SELECT feature_used, count(*) AS usage_count FROM facts WHERE feature_used IS NOT NULL
GROUP BY feature_used ORDER BY usage_count DESC, feature_used {limit}"""


def _usage_sql(src: str) -> str:
    return f"""WITH {facts_cte(src)}
SELECT "date", feature_used, count(feature_used) AS usage_count FROM facts
WHERE "date" IS NOT NULL AND feature_used IS NOT NULL GROUP BY "date", feature_used"""


def _range_sql(src: str) -> str:
    return f"""WITH {facts_cte(src)}
SELECT strftime(min("date"), '%Y-%m-%d') AS first_date, strftime(max("date"), '%Y-%m-%d') AS last_date,
       count(*) AS n_events, count(DISTINCT "date") AS n_days FROM facts"""


for _src, _sfx in (("events", ""), ("orders", "_orders")):

    def _bind(src: str):
        register(f"dau{_sfx}", _dau_sql(src))(lambda spark, d: metrics.dau(facts(spark, d, src)))
        register(f"wau{_sfx}", _wau_sql(src))(lambda spark, d: metrics.wau(facts(spark, d, src)))
        register(f"wau_iso{_sfx}", _wau_iso_sql(src))(lambda spark, d: metrics.wau_iso(facts(spark, d, src)))
        register(f"wau_week_start{_sfx}", _wau_week_start_sql(src))(
            lambda spark, d: metrics.with_week_start(metrics.wau(facts(spark, d, src)))
        )
        register(f"top_features{_sfx}", _top_sql(src))(lambda spark, d: metrics.top_features(facts(spark, d, src)))
        register(f"feature_usage_over_time{_sfx}", _usage_sql(src))(
            lambda spark, d: metrics.feature_usage_over_time(facts(spark, d, src))
        )
        register(f"activity_range{_sfx}", _range_sql(src))(
            lambda spark, d: metrics.activity_range(facts(spark, d, src))
        )

    _bind(_src)


@register("top_features_n", _top_sql("events", "LIMIT 5"))
def q_top_features_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.top_features_n(facts(spark, sf_dir, "events"), 5)


@register("top_features_n_orders", _top_sql("orders", "LIMIT 3"))
def q_top_features_n_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ranks 2 and 3 tie on count at 0.01 SF; the name breaks the tie.
    return metrics.top_features_n(facts(spark, sf_dir, "orders"), 3)


@register("stream_ingest_dau", _dau_sql("events"))
def q_stream_ingest_dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files (cut by day ranges) ingested by a streaming query into a date-partitioned
    fact table; DAU read from that table."""
    from usagelens.streaming import ingest_logs

    logs = scratch_path(spark, "stream-logs")
    act = adapters.activity(spark, sf_dir, "events")
    # Log files cut by (day, user) ranges; the last key lets a busy user's day be several files.
    tied = act.withColumn("__tie", F.monotonically_increasing_id())
    files.write_json_events(tied.repartitionByRange(F.to_date("timestamp"), "user_id", "__tie").drop("__tie"), logs)
    table = scratch_path(spark, "stream-facts")
    query = ingest_logs(spark, logs, table, scratch_path(spark, "stream-ckpt"), available_now=True)
    query.awaitTermination()
    return metrics.dau(spark.read.parquet(table))
