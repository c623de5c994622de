"""Reconcile two user tables produced by different runs.

Both tables are keyed by user_id (one row per user), so the full outer join
has no hot key.  When both sides come out of ``groupBy("user_id")`` in the same
job they are already hash-partitioned on the key and the join adds no shuffle.

* ``merge_tables``  - one row per user; a column present on both sides takes
  side 1's value, falling back to side 2's; key first, then columns sorted.
* ``discrepancies`` - one pass over the joined rows: for each common column,
  ``<c>_file1`` / ``<c>_file2`` hold the two values where they differ (both
  present), NULL where they agree; only users with some difference are kept.
* ``discrepancy_summary`` - per common column, how many users differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.columns import common_and_unique
from usagelens.functions.scalars import differs

SUFFIXES = ("_file1", "_file2")


def _joined(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, list[str], list[str], list[str]]:
    common, only_a, only_b = common_and_unique(
        [c for c in a.columns if c != key], [c for c in b.columns if c != key]
    )
    j = a.alias("a").join(b.alias("b"), on=key, how="full")
    return j, common, only_a, only_b


def merge_tables(a: DataFrame, b: DataFrame, key: str = "user_id") -> DataFrame:
    j, common, only_a, only_b = _joined(a, b, key)
    cols = {c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in common}
    cols.update({c: F.col(f"a.{c}") for c in only_a})
    cols.update({c: F.col(f"b.{c}") for c in only_b})
    return j.select(F.col(key), *[cols[c].alias(c) for c in sorted(cols)])


def _differs(c: str, tolerance: float | None) -> F.Column:
    """Both present and unequal; with ``tolerance``, numeric columns must differ
    by more than it (exact comparison otherwise)."""
    x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
    return differs(x, y) if tolerance is None else F.coalesce(F.abs(x - y) > F.lit(tolerance), F.lit(False))


def discrepancies(
    a: DataFrame, b: DataFrame, key: str = "user_id", suffixes=SUFFIXES, tolerance: float | None = None
) -> DataFrame:
    """``tolerance`` (numeric columns only) treats |a - b| <= tolerance as equal."""
    j, common, _, _ = _joined(a, b, key)
    numeric = {c for c in common if isinstance(a.schema[c].dataType, T.NumericType)}
    out = [F.col(key)]
    any_diff = F.lit(False)
    for c in common:
        d = _differs(c, tolerance if c in numeric else None)
        any_diff = any_diff | d
        out += [
            F.when(d, F.col(f"a.{c}")).alias(f"{c}{suffixes[0]}"),
            F.when(d, F.col(f"b.{c}")).alias(f"{c}{suffixes[1]}"),
        ]
    return j.where(any_diff).select(*out)


def discrepancy_summary(a: DataFrame, b: DataFrame, key: str = "user_id") -> DataFrame:
    """(column_name, users_differing, users_only_in_file1, users_only_in_file2)."""
    j, common, _, _ = _joined(a, b, key)
    present_a = F.col(f"a.{key}").isNotNull()
    present_b = F.col(f"b.{key}").isNotNull()
    agg = j.agg(
        *[F.count_if(differs(F.col(f"a.{c}"), F.col(f"b.{c}"))).alias(c) for c in common],
        F.count_if(present_a & ~present_b).alias("__only_a"),
        F.count_if(present_b & ~present_a).alias("__only_b"),
    )
    long = agg.unpivot(["__only_a", "__only_b"], common, "column_name", "users_differing")
    return long.select(
        "column_name",
        F.col("users_differing").cast("bigint").alias("users_differing"),
        F.col("__only_a").cast("bigint").alias("users_only_in_file1"),
        F.col("__only_b").cast("bigint").alias("users_only_in_file2"),
    )


def any_discrepancy(a: DataFrame, b: DataFrame, key: str = "user_id") -> bool:
    """Existence test: stops at the first differing row."""
    return not discrepancies(a, b, key).isEmpty()


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
