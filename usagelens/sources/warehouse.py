"""Warehouse loading: CSV files -> typed, checked tables.

A load reads every field as text and casts it to the target type with
``try_cast`` (a bad value becomes NULL instead of failing the job).  Each row
keeps the reasons why it is bad: ``row:malformed``, ``<column>:type`` (a
non-blank field that is no value of the type; integers may end in ``.0`` but not in
any other fraction), ``<column>:overflow`` (a number that is one, but too large for the
column), ``<column>:missing`` (a required field without a value) and ``<column>:length``.

Error policies:
* ``"skip_file"`` - any bad row rejects the whole file it came from
  (bad files = distinct ``_metadata.file_path`` of bad rows; rows of those files
  removed with a ``left_anti`` join, whose form Spark picks from measured sizes);
* ``"skip_row"``  - only bad rows are dropped;
* ``"abort"``     - raise if any row is bad.

``load_report`` lists every file with its rows, bad rows and reasons; stored
tables that take each version of a file once are in ``sources.ledger``.

CSV dialect: quotes inside quoted fields are doubled, blanks are kept, and with
``multiline=True`` quoted fields may hold line breaks (such a file is one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas
from usagelens.session import scratch_path
from usagelens.sources.files import DIALECT

CORRUPT = "_corrupt_record"
FILE = "__file"
REASONS = "__reasons"


def _text_schema(target: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.StringType()) for f in target.fields] + [T.StructField(CORRUPT, T.StringType())]
    )


def _typed(raw: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.TimestampNTZType):
        return raw.try_cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return F.try_to_date(raw)
    if isinstance(dtype, T.BooleanType):
        return F.lower(F.trim(raw)).try_cast("boolean")
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        # Integral columns accept "12" and "12.0" (files written from floats), not "12.7".
        return F.regexp_extract(F.trim(raw), _WHOLE, 1).try_cast(dtype)
    return raw.try_cast(dtype)


#: Spelling of a decimal number, of any size.
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_WHOLE = r"^([+-]?[0-9]+)(\.0*)?$"


def _is_number(raw: Column, dtype: T.DataType) -> Column:
    """Is the text a number of the column's kind, whether or not it fits?  Never so for other types."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.trim(raw).rlike(_WHOLE)
    if isinstance(dtype, T.DecimalType):
        return F.trim(raw).rlike(_DECIMAL)
    return F.lit(False)


def typed_rows(
    text: DataFrame,
    target: T.StructType,
    not_null: list[str] = (),
    max_len: dict[str, int] | None = None,
) -> DataFrame:
    """Text columns -> typed target columns, the file and the reasons why a row is bad (none: a good row)."""
    max_len = max_len or {}
    typed = []
    problems = [F.when(F.col(CORRUPT).isNotNull(), F.lit("row:malformed"))]
    for f in target.fields:
        raw = F.col(f.name)
        val = _typed(raw, f.dataType)
        typed.append(val.alias(f.name))
        is_text = isinstance(f.dataType, T.StringType)
        blank = raw.isNull() if is_text else raw.isNull() | (F.trim(raw) == "")
        if not is_text:
            lost = ~blank & val.isNull()
            problems.append(F.when(lost & ~_is_number(raw, f.dataType), F.lit(f"{f.name}:type")))
            problems.append(F.when(lost & _is_number(raw, f.dataType), F.lit(f"{f.name}:overflow")))
        if f.name in not_null:
            problems.append(F.when(blank, F.lit(f"{f.name}:missing")))
        if f.name in max_len:
            problems.append(F.when(F.length(raw) > F.lit(max_len[f.name]), F.lit(f"{f.name}:length")))
    return text.select(*typed, F.col(FILE), F.array_compact(F.array(*problems)).alias(REASONS))


def read_text_csv(
    spark: SparkSession, path: str | list[str], target: T.StructType, header: bool = True, multiline: bool = False
) -> DataFrame:
    """Fields bound by position to the target's columns, all as text, with the source file."""
    df = (
        spark.read.schema(_text_schema(target))
        .option("header", header)
        .option("enforceSchema", True)  # bind by position, not by header names
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
        .option("recursiveFileLookup", True)  # folders like part=1 are no columns
        .options(**DIALECT)
        .csv(path)
    )
    return df.withColumn(FILE, F.col("_metadata.file_path"))


def is_bad() -> Column:
    return F.size(REASONS) > 0


def apply_policy(flagged: DataFrame, policy: str = "skip_file", keep_file: bool = False) -> DataFrame:
    if policy == "skip_row":
        good = flagged.where(~is_bad())
    elif policy == "skip_file":
        bad_files = flagged.where(is_bad()).select(FILE).distinct()
        good = flagged.join(bad_files, FILE, "left_anti")
    elif policy == "abort":
        if not flagged.where(is_bad()).isEmpty():
            raise ValueError("load aborted: input has rows that do not fit the table")
        good = flagged
    else:
        raise ValueError(f"unknown error policy {policy}")
    return good.drop(REASONS) if keep_file else good.drop(FILE, REASONS)


def load_report(flagged: DataFrame, policy: str = "skip_file") -> DataFrame:
    """One row per file: file, rows, bad_rows, reasons (sorted, comma-joined) and status.

    A file's distinct reasons are bounded by the columns of the table."""
    per_file = flagged.groupBy(F.col(FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_bad()).alias("bad_rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(REASONS)))).alias("reasons"),
    )
    left_out = {"skip_file": "skipped", "skip_row": "partly loaded"}.get(policy, "aborted")
    status = F.when(F.col("bad_rows") > 0, F.lit(left_out)).otherwise(F.lit("loaded"))
    return per_file.select("file", "rows", "bad_rows", F.array_join("reasons", ",").alias("reasons"), status.alias("status"))


def flagged_rows(
    spark: SparkSession,
    path: str | list[str],
    target: T.StructType,
    not_null: list[str] = (),
    max_len: dict[str, int] | None = None,
    header: bool = True,
    multiline: bool = False,
    stage: bool = True,
) -> DataFrame:
    """Typed rows with their file and reasons.  ``stage`` parses the CSV once into a typed
    Parquet stage in the shared checkpoint folder (also cutting lineage), as both the
    list of bad files and the good rows need them."""
    flagged = typed_rows(read_text_csv(spark, path, target, header, multiline), target, not_null, max_len)
    if not stage:
        return flagged
    stage_path = scratch_path(spark, "load-stage")
    flagged.write.mode("overwrite").parquet(stage_path)
    return spark.read.parquet(stage_path)


def load_csv(
    spark: SparkSession,
    path: str,
    target: T.StructType,
    policy: str = "skip_file",
    not_null: list[str] = (),
    max_len: dict[str, int] | None = None,
    header: bool = True,
    stage: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Positional load of CSV files into the typed ``target`` layout."""
    stage = stage and policy == "skip_file"
    return apply_policy(flagged_rows(spark, path, target, not_null, max_len, header, multiline, stage), policy)


def bad_files(spark: SparkSession, path: str, target: T.StructType, not_null=(), max_len=None) -> DataFrame:
    """Files that a ``skip_file`` load would reject, with their bad-row counts."""
    report = load_report(flagged_rows(spark, path, target, not_null, max_len, stage=False))
    return report.where("bad_rows > 0").select(F.col("file").alias(FILE), "bad_rows")


def load_with_columns(
    spark: SparkSession,
    path: str,
    file_columns: list[str],
    target: T.StructType,
    rename: dict[str, str],
    policy: str = "skip_file",
    not_null: list[str] = (),
    max_len: dict[str, int] | None = None,
) -> DataFrame:
    """Load with an explicit column list: file fields (by position) are named
    ``file_columns`` and renamed by ``rename`` onto target columns; target columns
    not listed (e.g. a generated id) are left out.  ``not_null`` / ``max_len``
    name target columns."""
    to_target = {c: rename.get(c, c) for c in file_columns}
    layout, required, limits = file_layout(file_columns, target, rename, not_null, max_len)
    rows = load_csv(spark, path, layout, policy, required, limits)
    return rows.select(*[F.col(c).alias(to_target[c]) for c in file_columns])


def file_layout(
    file_columns: list[str],
    target: T.StructType,
    rename: dict[str, str],
    not_null: list[str] = (),
    max_len: dict[str, int] | None = None,
) -> tuple[T.StructType, list[str], dict[str, int]]:
    """The file's own columns with the types, required columns and length limits of the target."""
    by_name = {f.name: f for f in target.fields}
    to_target = {c: rename.get(c, c) for c in file_columns}
    layout = T.StructType([T.StructField(c, by_name[to_target[c]].dataType) for c in file_columns])
    limits = {c: (max_len or {})[t] for c, t in to_target.items() if t in (max_len or {})}
    return layout, [c for c, t in to_target.items() if t in not_null], limits


# ---- typed tables ---------------------------------------------------------------


def dim_users_schema(platforms: list[str] = schemas.DEFAULT_PLATFORMS) -> T.StructType:
    """DIM_USERS with one count column per platform: key first, rest in case-sensitive name order."""
    types = {f.name: f.dataType for f in schemas.DIM_USERS.fields if not f.name.startswith("platform_")}
    for c in schemas.platform_columns(platforms):
        types[c] = T.LongType()
    names = ["user_id"] + sorted(n for n in types if n != "user_id")
    return T.StructType([T.StructField(n, types[n]) for n in names])


def _cast(df: DataFrame, f: T.StructField) -> Column:
    if f.name not in df.columns:
        return F.lit(None).cast(f.dataType)
    c = F.col(f.name)
    if isinstance(f.dataType, T.DecimalType) and isinstance(df.schema[f.name].dataType, (T.DoubleType, T.FloatType)):
        # Round the shortest decimal text of the double (2.675 -> 2.68).
        c = c.cast("string")
    return c.try_cast(f.dataType)


def cast_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast columns by name onto a typed layout (missing columns -> NULL); values
    that do not fit (e.g. decimal overflow) become NULL: ``cast_losses`` counts them."""
    return df.select(*[_cast(df, f).alias(f.name) for f in target.fields])


def cast_losses(df: DataFrame, target: T.StructType) -> DataFrame:
    """(column_name, lost): the values of each column that ``cast_to`` turns into NULL (one aggregate)."""
    there = [f for f in target.fields if f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(f.name).isNotNull() & _cast(df, f).isNull()).alias(f.name) for f in there])
    return counts.unpivot([], counts.columns, "column_name", "lost")


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def cluster_fact_events(facts: DataFrame) -> DataFrame:
    """Lay fact rows out by day, then user: each task holds whole days, sorted by
    user inside, so a ``partitionBy("date")`` write makes one sorted file set per
    day and day filters prune to those folders."""
    # A unique last key lets the range boundaries split a busy day, and a busy
    # user of one day, over several tasks.
    tied = facts.withColumn("__tie", F.monotonically_increasing_id())
    return tied.repartitionByRange("date", "user_id", "__tie").sortWithinPartitions("date", "user_id").drop("__tie")
