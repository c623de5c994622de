"""Exact "first n rows per group in hash order" without sorting the table.

Used for the stratified split (first ceil(0.2 n) users of each class in
md5 order) and for SMOTE's spread (first N mod m minority rows in hash order).

1. every row gets a uniform 16-bit bucket from its hash key;
2. a histogram of (group, bucket) counts - at most groups x 65536 rows, built
   with map-side partial counts - gives, per group, the bucket where the n-th
   row falls and how many rows of that bucket are still needed;
3. rows in earlier buckets are in, later buckets out; only rows of the boundary
   bucket (about 1/65536 of a group) are ranked, in a window over the group, to
   find its last row that is in: one row per group, which the others of that bucket
   are compared with.  No row is joined back, so the flag can be read again cheaply.

The hash is uniform, so buckets hold no hot key even when one group has most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.session import stored

BUCKETS = 1 << 16


def _bucket(hex_key: Column) -> Column:
    return F.conv(F.substring(hex_key, 1, 4), 16, 10).cast("int")


def flag_first_n(
    df: DataFrame, group_col: str, hex_key: Column, n_per_group: Column, flag_col: str, id_col: str
) -> DataFrame:
    """Add boolean ``flag_col``: True for the ``n_per_group`` rows of each group
    with the smallest ``hex_key`` (a hex digest, unique per row; ties by id).

    ``n_per_group`` is a Column over ``__size`` (rows in the group), e.g.
    ``ceil(0.2 * __size)``.  ``id_col`` must be unique.
    """
    # Read three times (histogram, all rows, boundary rows): write it once.
    keyed = stored(df.withColumns({"__key": hex_key}).withColumn("__b", _bucket(F.col("__key"))), "keyed")
    hist = keyed.groupBy(group_col, "__b").agg(F.count(F.lit(1)).alias("__c"))
    # At most 65536 rows per group: windows over the histogram are small.
    w_grp = Window.partitionBy(group_col)
    w_cum = Window.partitionBy(group_col).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    cum = (
        hist.withColumn("__size", F.sum("__c").over(w_grp))
        .withColumn("__cum", F.sum("__c").over(w_cum))
        .withColumn("__n", n_per_group.cast("bigint"))
    )
    is_edge = (F.col("__cum") >= F.col("__n")) & (F.col("__cum") - F.col("__c") < F.col("__n"))
    per_group_plan = cum.groupBy(group_col).agg(
        F.first("__size").alias("__size"),
        F.first("__n").alias("__n"),
        F.max(F.when(is_edge, F.col("__b"))).alias("__bb"),
        F.max(F.when(is_edge, F.col("__n") - (F.col("__cum") - F.col("__c")))).alias("__need"),
    )
    # One row per group (a group with n <= 0 or n >= its size has no boundary).  As Arrow it is a
    # local table in the plan; made from Python rows it would start Python workers.
    spark = df.sparkSession
    bounds = spark.createDataFrame(per_group_plan.toArrow())
    edge = keyed.join(F.broadcast(bounds), group_col).where(F.col("__b") == F.col("__bb"))
    last = (
        edge.withColumn("__r", F.row_number().over(Window.partitionBy(group_col).orderBy("__key", id_col)))
        .where(F.col("__r") == F.col("__need"))
        .select(group_col, F.struct(F.col("__key").alias("key"), F.col(id_col).alias("id")).alias("__last"))
    )
    per_group = F.broadcast(spark.createDataFrame(bounds.join(last, group_col, "left").toArrow()))
    out = keyed.join(per_group, group_col, "left")
    up_to_last = F.struct(F.col("__key").alias("key"), F.col(id_col).alias("id")) <= F.col("__last")
    flag = (
        F.when(F.col("__n") <= 0, F.lit(False))
        .when(F.col("__n") >= F.col("__size"), F.lit(True))
        .when(F.col("__b") < F.col("__bb"), F.lit(True))
        .when(F.col("__b") > F.col("__bb"), F.lit(False))
        .when(F.col("__b") == F.col("__bb"), F.coalesce(up_to_last, F.lit(False)))
        .otherwise(F.lit(False))
    )
    return out.withColumn(flag_col, flag).select(*df.columns, flag_col)
