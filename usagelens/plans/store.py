"""Stored warehouse tables for the dashboard: written once, read with pruning.

``fact_events`` has a folder a day and is sorted by user inside; ``feature_usage`` has a
folder a month (a day holds one row a feature, too little for a folder); the small
summaries are plain tables.  A date range given as values prunes folders when the
query is planned, a join with chosen days prunes them when it runs, and a view
reads only the columns it shows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators import metrics
from usagelens.session import scratch_path
from usagelens.sources import storage, warehouse

ALL = ("fact_events", "daily_active_users", "weekly_active_users", "feature_usage", "feature_summary")
_FOLDERS = {"fact_events": ["date"], "feature_usage": ["month"]}


def month_of(date) -> F.Column:
    return F.date_format(date, "yyyy-MM")


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def days(self, name: str, first, last) -> DataFrame:
        """Rows of ``fact_events`` or ``feature_usage`` from ``first`` to ``last`` (dates); other folders are not read."""
        rows = self.table(name).where(F.col("date").between(F.lit(first), F.lit(last)))
        if _FOLDERS[name] == ["month"]:
            rows = rows.where(F.col("month").between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
        return rows

    def on_days(self, name: str, days: DataFrame) -> DataFrame:
        """Rows of the days in ``days`` (column ``date``, one row a day): a join that prunes folders as it runs."""
        return self.table(name).join(days.select("date"), "date")


def build(facts: DataFrame, path: str, tables: tuple[str, ...] = ALL) -> Store:
    """Write the chosen tables from fact rows (date, week and year added).  The summaries are computed from the stored facts if there are any."""
    spark, store = facts.sparkSession, Store(facts.sparkSession, path)
    if "fact_events" in tables:
        events = facts.withColumnRenamed("session_length", "session_length_sec")  # rows without a date get a folder of their own
        warehouse.save_table(warehouse.cluster_fact_events(events), f"{path}/fact_events", _FOLDERS["fact_events"])
        facts = store.table("fact_events")
    makers = {
        "daily_active_users": lambda: metrics.dau(facts).withColumnsRenamed({"date": "activity_date", "active_users": "daily_active_users"}),
        "weekly_active_users": lambda: metrics.with_week_start(metrics.wau(facts)).withColumnRenamed("active_users", "weekly_active_users"),
        "feature_usage": lambda: metrics.feature_usage_over_time(facts).withColumnsRenamed({"feature_used": "feature_name", "usage_count": "daily_usage_count"}).withColumn("month", month_of("date")),
        "feature_summary": lambda: metrics.top_features(facts),
    }
    for name in tables:
        if name in makers:
            warehouse.save_table(makers[name](), f"{path}/{name}", _FOLDERS.get(name))
    return Store(spark, path)


_BUILT: dict[tuple, str] = {}


def opened(spark: SparkSession, key: str, facts, tables: tuple[str, ...] = ALL) -> Store:
    """The store of ``facts()`` under ``key``, built on first use in a session and read from then on."""
    at = (spark.sparkContext.applicationId, key, tables)
    if at not in _BUILT or not storage.children(spark, _BUILT[at]):
        path = scratch_path(spark, "store")
        build(facts(), path, tables)
        _BUILT[at] = path
    return Store(spark, _BUILT[at])
