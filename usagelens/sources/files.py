"""File sources and sinks at the edges of the pipeline (JSON logs, CSV tables).

Readers always take an explicit schema (no inference pass over the data).
JSON Lines split across tasks by lines.  A JSON array (the original log format) is
cut at every closing brace, so one large file is read by many tasks; which of the
braces end a record follows from running sums of quotes and brackets over the pieces
(see ``array_records``).

Records that do not parse are rejected: ``read_json_events`` leaves them out, and
``json_records`` / ``csv_records`` give them as a table of their own, with file and text.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens import schemas
from usagelens.session import stored

log = logging.getLogger(__name__)

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
#: CSV dialect of reads and writes: doubled quotes, blanks kept.
DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CORRUPT = "_corrupt_record"


@dataclass
class Records:
    """Parsed records, and the rejected ones as (file, record); ``flags`` has one boolean a record: is it rejected?"""

    good: DataFrame
    rejected: DataFrame
    flags: DataFrame

    def counts(self) -> DataFrame:
        """One row: records read, and those rejected."""
        return self.flags.agg(F.count(F.lit(1)).alias("records"), F.count_if("bad").alias("corrupt_records"))


def read_json_events(
    spark: SparkSession, path: str, multiline: bool = False, schema: T.StructType = schemas.RAW_EVENT
) -> DataFrame:
    """Raw log records with the raw schema (timestamp kept as text); records that do not parse are left out.

    ``multiline`` reads files that are one JSON array each.  A path that does not exist
    is logged and gives no records."""
    return json_records(spark, path, multiline, schema).good


def json_records(spark: SparkSession, path: str | list[str], multiline: bool = False, schema: T.StructType = schemas.RAW_EVENT) -> Records:
    """The records of JSON logs, and those that do not parse into ``schema``."""
    try:
        texts = array_records(spark, path) if multiline else _lines(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no log file at %s", path)
        return Records(spark.createDataFrame([], schema), spark.createDataFrame([], "file string, record string"), spark.createDataFrame([], "bad boolean"))
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # from_json with options parses the whole schema whatever columns are asked for later
    parsed = F.from_json("record", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    texts = texts.withColumn("parsed", parsed)
    bad = F.col(f"parsed.{CORRUPT}").isNotNull()
    return Records(texts.where(~bad).select(*[F.col(f"parsed.`{f.name}`") for f in schema.fields]), texts.where(bad).select("file", "record"), texts.select(bad.alias("bad")))


def count_corrupt_json(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_EVENT, multiline: bool = False) -> DataFrame:
    """One row: records read, and those that do not parse into the schema."""
    return json_records(spark, path, multiline, schema).counts()


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))
    return lines.where(F.trim("record") != "")


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, record): the text of every element of JSON array files, many tasks to a file.

    The files are read with ``}`` as the line end.  A piece starts inside a string if
    the pieces before it hold an odd number of quotes (escaped characters aside); so the
    brackets outside strings, and with them the depth after each piece, are running sums.
    The sums are taken inside a task's range of the file, and ranges are put together
    from one row each.  A piece that ends at the array's own depth ends a record.  What
    follows the last record (a cut-off one) is a record too, unless it is only the
    array's end.  A file that is no array holds records one after another.  Where a
    quote is missing, all that follows in the file is one record."""
    raw = spark.read.option("lineSep", "}").text(path)
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size")]
    pieces = raw.select(*meta, F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"))
    parts = F.split(F.regexp_replace("piece", r"\\[\s\S]", ""), '"', -1)

    def change(first: int) -> Column:
        """Change of depth over every second part, beginning with ``first``."""
        outside = F.array_join(F.filter(parts, lambda x, i: i % 2 == first), "")
        n = lambda signs: F.length(outside) - F.length(F.translate(outside, signs, ""))
        return (n("{[") - n("]}")).cast("long")

    pieces = stored(pieces.withColumns({"quotes": (F.size(parts) - 1).cast("long"), "out": change(0), "inside": change(1)}), "json-pieces")
    # one row a file: does it begin with a bracket, and is its last piece cut off before a brace?
    place = F.struct("block", "at")
    per_file = pieces.groupBy("file").agg(
        F.min_by(F.substring("piece", 1, 100), place).rlike(r"^\s*\[").cast("int").alias("top"),
        F.max(place).alias("end"),
        (F.sum(F.octet_length("piece") + 1) > F.first("size")).alias("cut"),
    )
    upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def before(rows: DataFrame, value: str, name: str) -> DataFrame:
        """Add the sum of ``value`` over all earlier pieces of the file."""
        blocks = rows.groupBy("file", "block").agg(F.sum(value).alias("n"))  # one row a range of a file
        carried = blocks.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("carried"))
        return rows.withColumn(name, F.sum(value).over(upto) - F.col(value)).join(carried, ["file", "block"]).withColumn(name, F.col(name) + F.col("carried")).drop("carried")

    rows = before(pieces, "quotes", "open").join(per_file, "file")
    rows = rows.withColumn("closed", ~(F.col("cut") & (place == F.col("end"))))
    ends_outside = (F.col("open") + F.col("quotes")) % 2 == 0
    braces = F.when(F.col("open") % 2 == 0, F.col("out")).otherwise(F.col("inside"))
    rows = rows.withColumn("change", braces - (F.col("closed") & ends_outside).cast("long"))
    rows = stored(before(rows, "change", "depth"), "json-depths")
    ended = F.col("closed") & ends_outside & (F.col("depth") + F.col("change") == F.col("top"))
    rows = before(rows.withColumn("ends", ended.cast("long")), "ends", "number")
    whole = F.array_sort(F.collect_list(F.struct("block", "at", "piece", "closed")))
    texts = rows.groupBy("file", "number").agg(whole.alias("whole"))
    text = F.concat(F.array_join("whole.piece", "}"), F.when(F.element_at("whole.closed", -1), F.lit("}")).otherwise(F.lit("")))
    texts = texts.select("file", F.regexp_replace(text, r"^[\s,]*\[?[\s,]*", "").alias("record"))
    return texts.where(~F.col("record").rlike(r"^\s*\]?\s*$"))


def csv_records(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, **options) -> Records:
    """The rows of CSV files, and those with a wrong number of fields or a field that does not fit its type.

    The files are parsed once, into a Parquet stage that both tables are read from."""
    layout = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = read_csv(spark, path, layout, header, columnNameOfCorruptRecord=CORRUPT, **options)
    staged = stored(rows.withColumn("__file", F.col("_metadata.file_path")), "csv-records")
    bad = F.col(CORRUPT).isNotNull()
    return Records(staged.where(~bad).select(*schema.names), staged.where(bad).select(F.col("__file").alias("file"), F.col(CORRUPT).alias("record")), staged.select(bad.alias("bad")))


def write_json_array(df: DataFrame, path: str) -> None:
    """Records as one JSON array per file (the original log format); files are written by the tasks, row by row."""

    def lines(batches):
        import pyarrow as pa

        before = "["
        for batch in batches:
            records = batch.column(0).to_pylist()
            if records:
                yield pa.RecordBatch.from_arrays([pa.array([before + records[0], *("," + r for r in records[1:])])], names=["value"])
                before = ","
        if before == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    fields = [F.date_format(c, TS_FORMAT).alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes]
    records = df.select(F.to_json(F.struct(*fields)).alias("record"))
    records.mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def write_json_events(df: DataFrame, path: str) -> None:
    """Records as JSON Lines with ISO timestamps (one file per task)."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out = out.withColumn(f.name, F.date_format(F.col(f.name), TS_FORMAT))
    out.write.mode("overwrite").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, **options) -> DataFrame:
    reader = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").options(**DIALECT)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_csv_projected(
    spark: SparkSession, path: str, schema: T.StructType, columns: list[str], header: bool = True
) -> DataFrame:
    """Read only ``columns`` of a CSV table (the CSV parser skips the others)."""
    return read_csv(spark, path, schema, header).select(*columns)


def write_csv(df: DataFrame, path: str, header: bool = True, partition_by: list[str] = ()) -> None:
    """Overwrite a CSV table directory with a header line per part file.

    Timestamps keep their microseconds (the writer's default drops them)."""
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("timestampNTZFormat", TS_FORMAT)
        .option("timestampFormat", TS_FORMAT)
        .options(**DIALECT)
        .partitionBy(*partition_by)
        .csv(path)
    )


def write_csv_ordered(df: DataFrame, path: str, order_by: list[Column | str]) -> None:
    """A CSV table whose part files, taken by name, hold the rows in ``order_by`` order (a distributed sort)."""
    write_csv(df.orderBy(*order_by), path)


def out_of_order(spark: SparkSession, path: str, schema: T.StructType, later: Callable[[Column, Column], Column], **options) -> DataFrame:
    """One row: ``rows`` of the CSV table at ``path``, and how many of them come before their predecessor in the order
    of files and lines.

    ``later(before, row)`` tells of two neighbouring rows (structs) whether they are in order.  Lines are
    compared inside each range of a file, and the ends of neighbouring ranges with each other (one row a range)."""
    rows = read_csv(spark, path, schema, **options)
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")]
    rows = rows.select(*place, F.struct(*schema.names).alias("row"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    wrong = F.count_if(~later(F.col("before"), F.col("row"))).alias("n")
    within = rows.withColumn("before", F.lag("row").over(inside)).where("before IS NOT NULL").agg(wrong)
    ends = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("rows"), F.min_by("row", "at").alias("row"), F.max_by("row", "at").alias("end"))
    ends = ends.withColumn("before", F.lag("end").over(Window.orderBy("file", "block")))
    between = ends.agg(F.count_if(F.col("before").isNotNull() & ~later(F.col("before"), F.col("row"))).alias("n"), F.sum("rows").alias("rows"))
    return between.select(F.coalesce("rows", F.lit(0)).alias("rows"), (F.col("n") + within.scalar()).alias("out_of_order"))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write ``df`` as CSV only if it has rows (a conditional sink); True if written.  ``df`` is computed once."""
    rows = stored(df, "maybe-empty")
    if rows.isEmpty():
        return False
    write_csv(rows, path)
    return True
