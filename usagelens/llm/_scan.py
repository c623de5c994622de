"""Ranks and running sums inside keys of any size, and joins with keys that hold many rows.

A window over one key is one task, however many rows the key has.  Here rows are
range-partitioned by key and order, so a large key spreads over partitions; ranks
and sums are taken inside (partition, key), and what earlier partitions of the
same key add is carried over from a table of at most two rows a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm._common import checkpointed, unused

PART = "_part"
#: Keys with at least one row in HOT are joined by broadcast: there can be no more than HOT of them.
HOT = 1000


def placed(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` range-partitioned by ``keys`` and ``order``, checkpointed, with the partition's number in ``PART``.

    Rows equal in all of these are interchangeable and may spread over partitions."""
    tie = unused(df, "_tie")
    spread = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*[F.col(k) for k in keys], *order, tie)
    return checkpointed(spread.withColumn(PART, F.spark_partition_id().cast("long")).drop(tie))


def within(keys: list[str], order: list[Column]):
    """Window of the rows of a key inside a partition up to the current one."""
    return Window.partitionBy(PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def ranked(df: DataFrame, keys: list[str], order: list[Column], rank: str, size: str, sums: dict[str, str] | None = None) -> DataFrame:
    """Add the 0-based ``rank`` of a row in its key, the number of rows ``size`` of the key, and for each
    ``name: column`` of ``sums`` the running sum of the column up to the row.  Keys hold no nulls."""
    sums = sums or {}
    rows = placed(df, keys, order)
    upto, whole = within(keys, order), Window.partitionBy(PART, *keys)
    local = rows.withColumn(rank, (F.row_number().over(Window.partitionBy(PART, *keys).orderBy(*order)) - 1).cast("long"))
    local = local.withColumn(size, F.count(F.lit(1)).over(whole))
    for name, column in sums.items():
        local = local.withColumn(name, F.sum(column).over(upto))
    pieces = rows.groupBy(PART, *keys).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    every, before = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    if not keys:  # one piece a partition
        every, before = Window.partitionBy(), Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = {rank: F.sum("_n").over(before), **{n: F.sum(f"_s_{n}").over(before) for n in sums}}
    spans = pieces.select(PART, *keys, F.count(F.lit(1)).over(every).alias("_parts"), F.sum("_n").over(every).alias("_all"), *[F.coalesce(c, F.lit(0)).alias(f"_c_{n}") for n, c in carry.items()])
    spans = spans.filter("_parts > 1")  # keys in several partitions: at most two a partition
    out = local.join(F.broadcast(spans), [PART, *keys], "left")
    added = {n: F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in carry}
    return out.withColumns({**added, size: F.coalesce("_all", F.col(size))}).select(*df.columns, rank, size, *sums)


def joined(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, stored: bool = False) -> DataFrame:
    """Join stored ``rows`` (``total`` of them) with ``table``, which has one row a key and in ``weight`` the
    number of rows of that key: heavy keys by a broadcast of at most ``HOT`` rows, the others by a shuffle.

    If the table is ``stored`` too, it is looked at first: without a heavy key there is one plain join."""
    heavy = F.col(weight) * HOT >= F.lit(total)
    if stored and table.filter(heavy).isEmpty():
        return rows.join(table, keys)
    others = rows.join(F.broadcast(table.filter(heavy).select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(table.filter(heavy)), keys).unionByName(others.join(table.filter(~heavy), keys))
