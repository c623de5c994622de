"""Table constraints (primary key, NOT NULL, string length) as data checks.

Each check is one aggregate pass; reports come back in long form
(table_name, column_name, ..., violations) so several tables stack by union.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def primary_key_report(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """rows, distinct keys, keys seen more than once, and rows with a NULL key part."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("__n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(null_key, F.col("__n"))), F.lit(0)).cast("bigint").alias("null_keys"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The offending key values and how often each occurs."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def not_null_report(df: DataFrame, cols: list[str], table: str) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _long(counts, cols, table, "violations")


def length_report(df: DataFrame, limits: dict[str, int], table: str) -> DataFrame:
    cols = list(limits)
    counts = df.agg(*[F.count_if(F.length(F.col(c)) > F.lit(n)).alias(c) for c, n in limits.items()])
    out = _long(counts, cols, table, "violations")
    lim = F.create_map(*[x for c, n in limits.items() for x in (F.lit(c), F.lit(n))])
    return out.withColumn("max_length", lim[F.col("column_name")].cast("int"))


def _long(one_row: DataFrame, cols: list[str], table: str, value: str) -> DataFrame:
    long = one_row.unpivot([], cols, "column_name", value)
    return long.select(F.lit(table).alias("table_name"), "column_name", F.col(value).cast("bigint").alias(value))
