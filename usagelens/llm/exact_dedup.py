"""Exact duplicates: digest runs merged over binomial rounds of partitions, in DataFrame functions only.

Two texts are equal when they are identical after every run of blanks, tabs, line
feeds, vertical tabs, form feeds and carriage returns is replaced by one blank.
Each partition of the table first makes a run: its distinct digests (SHA-256 of
the normalised text), sorted, each with its smallest identifier and its number of
rows.  Then partitions exchange runs in rounds: in round r the runs of ``FAN``
neighbouring partitions (numbers equal after division by ``FAN`` ** r) meet, cut by
the leading digits of the digest so that no partition receives more than its
share, and are merged in digest order, the smallest identifier of equal digests
staying.  After as many rounds as ``FAN`` must be multiplied to reach the number of
partitions, every digest is in one place.  The way back goes through the same
rounds, so an entry is sent to at most ``FAN`` others: a text that a third of
all rows share costs one entry a partition and never gathers its rows.

Entries merge only if their length in bytes and a second 64-bit hash of the
normalised text agree as well (checked at every level); texts that share no more
than the digest would stay apart.

Defined cases: a null text counts as empty, and all empty texts are one group; of
rows that repeat the smallest id of a group one stays; rows with a null id come
after all others, so such a row stays (with a null ``keep_id``) only if its whole
group has none; an empty table gives no rows; other columns are not read, whatever
their names.  A text is normalised whole, by one task, in memory: its length is
bounded by what a Spark string may hold (2 GB) and an executor's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm._common import unused
from usagelens.session import stored

#: Runs that meet in one round: one hexadecimal digit of the digest.
FAN = 16
_KEY = ["digest", "size", "mark"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _merged(entries: DataFrame, digits: int) -> DataFrame:
    """Entries (run, digest, size, mark, least, n) with equal run and text made one, in digest order.

    The exchange deals by run and leading digits, so the merge itself needs no further one."""
    dealt = entries.withColumn("slice", F.substring("digest", 1, digits))
    sorted_runs = dealt.repartition("run", "slice").sortWithinPartitions("run", "slice", *_KEY)
    return sorted_runs.groupBy("run", "slice", *_KEY).agg(F.min("least").alias("least"), F.sum("n").alias("n")).drop("slice")


def exact_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    rows = rows.select("doc_id", F.sha2("norm", 256).alias("digest"), F.octet_length("norm").alias("size"), F.xxhash64("norm").alias("mark"))
    # the written table fixes which rows are one run, whatever is computed again later
    rows = stored(rows.withColumns({"run": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "digests")
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    least = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    levels = [stored(_merged(rows.select("run", *_KEY, least.alias("least"), F.lit(1).cast("long").alias("n")), 1), "runs-0")]
    while FAN ** (len(levels) - 1) < runs:
        lower = levels[-1].withColumn("run", F.floor(F.col("run") / FAN).cast("int"))
        levels.append(stored(_merged(lower, len(levels) + 1), f"runs-{len(levels)}"))
    known = levels.pop().select("run", *_KEY, "least", "n")
    while levels:
        lower = levels.pop().select(F.col("run").alias("own"), F.floor(F.col("run") / FAN).cast("int").alias("run"), *_KEY)
        known = lower.join(known, ["run", *_KEY]).select(F.col("own").alias("run"), *_KEY, "least", "n")
    out = rows.join(known, ["run", *_KEY])
    return out.select(
        "doc_id",
        F.col("least.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("least.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of ``docs``, with all its columns, of each group of equal texts: the one that :func:`exact_groups` keeps
    (of rows that repeat the smallest id with an equal text any one)."""
    digest = unused(docs, "_digest")
    kept = exact_groups(docs, text_col, id_col).filter("kept").select(F.col("doc_id").alias(f"{digest}_id"), F.col("text_sha256").alias(f"{digest}_kept"))
    rows = docs.withColumn(digest, F.sha2(normalised(F.col(text_col)), 256))
    same = (F.col(digest) == F.col(f"{digest}_kept")) & F.col(id_col).eqNullSafe(F.col(f"{digest}_id"))
    return rows.join(kept, same, "left_semi").dropDuplicates([digest]).drop(digest)
