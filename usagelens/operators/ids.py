"""Dense row ids 1..n in a sort order, without a single-partition window.

``row_number() over (order by ...)`` with no partition key moves every row
into one task.  Instead:

1. range-partition and sort by the key (``orderBy``: sampled boundaries, all
   tasks busy; a unique tiebreaker splits runs of equal keys);
2. tag rows with ``monotonically_increasing_id`` = (partition << 33) + position;
3. materialise that tagging once (``checkpoint`` into the shared checkpoint
   folder) so both uses below see the same partitions even if an executor is
   lost and tasks rerun;
4. count rows per partition (one small row per partition) and turn the counts
   into start offsets;
5. id = offset[partition] + position + 1, joining the offsets as a broadcast
   (its size is the number of partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.operators.joins import bounded_broadcast
from usagelens.session import ensure_checkpoint_dir

_POS_BITS = 33


def with_dense_id(df: DataFrame, order_by: list[Column | str], id_col: str = "event_id", start: int = 1) -> DataFrame:
    """Append ``id_col`` numbering rows ``start, start+1, ...`` in ``order_by`` order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # A unique last sort key lets the range partitioner split a hot key (rows
    # equal on every ``order_by`` column) over several tasks; such rows are
    # interchangeable, so any order among them is right.
    tie = F.monotonically_increasing_id().alias("__tie")
    tagged = (
        df.select("*", tie)
        .orderBy(*order_by, "__tie")
        .drop("__tie")
        .withColumn("__mid", F.monotonically_increasing_id())
    )
    tagged = tagged.withColumns(
        {
            "__part": F.shiftright(F.col("__mid"), _POS_BITS),
            "__pos": F.col("__mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)),
        }
    ).checkpoint(eager=True)
    counts = tagged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: a window over it is tiny and bounded.
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__offset"))
    out = tagged.join(bounded_broadcast(offsets), "__part").withColumn(
        id_col, (F.col("__offset") + F.col("__pos") + F.lit(start)).cast("bigint")
    )
    return out.select(id_col, *df.columns)


def rank_within_groups(
    df: DataFrame, group_col: str, order_by: list[Column | str], rank_col: str = "rank"
) -> DataFrame:
    """1-based rank inside each group for tables with *few, large* groups (e.g.
    class labels), where ``row_number() over (partition by group)`` would put a
    whole class into one task.  Dense ids over (group, order) minus the number
    of rows in earlier groups; the per-group counts are a tiny aggregate."""
    ided = with_dense_id(df, [F.col(group_col), *order_by], "__gid")
    sizes = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("__size"))
    w = Window.orderBy(group_col).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group_col, F.coalesce(F.sum("__size").over(w), F.lit(0)).alias("__start"))
    # One row per group: broadcast is bounded by the number of groups.
    out = ided.join(bounded_broadcast(starts), group_col, "left")
    return out.withColumn(rank_col, (F.col("__gid") - F.col("__start")).cast("bigint")).drop("__gid", "__start")
