"""Stored tables fed from files, with a ledger of which version of which file is loaded.

A table is a folder with ``rows/load_id=<id>`` (typed rows and the file they came
from), ``ledger/load_id=<id>`` (one row per file that the load looked at: its
version, rows, bad rows, reasons and status) and ``commits`` (one row per finished
load, written last).  A load counts only from its commit on, so one that fails
halfway leaves nothing behind that readers see; ``vacuum`` removes what it wrote.

A file's *version* is its size and modification time (``identity="stat"``), or a
digest of its lines (``identity="content"``, which reads every file again but takes
a copied or touched file for what it is).  A load parses only files whose newest
loaded version is not the present one: new files, changed ones, and rejected ones,
which are looked at again each time until they are repaired.  The rows of a
changed file take the place of its earlier rows (``versions="newest"``); readers may
ask for the rows of all versions instead, as a plain append would have left them.

Only names of the files still to load reach the driver (Spark lists them there
anyway).  Loads of one table run one after another.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.session import stored
from usagelens.sources import storage, warehouse
from usagelens.sources.warehouse import FILE

LEDGER = "file string, size long, modified timestamp, content string, rows long, bad_rows long, reasons string, status string, load_no long, load_id string"
LOADED = ("loaded", "partly loaded")
_VERSION = {"stat": ["size", "modified"], "content": ["content"]}


def file_versions(spark: SparkSession, path: str, identity: str = "stat") -> DataFrame:
    """(file, path, size, modified, content) of every file under ``path``; only a content identity reads them."""
    nested = {"recursiveFileLookup": "true"}
    listed = spark.read.format("binaryFile").options(**nested).load(path)
    listed = listed.select(F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    if identity == "stat":
        return listed.withColumn("content", F.lit(None).cast("string"))
    lines = spark.read.options(**nested).text(path).select(F.col("_metadata.file_path").alias("file"), F.xxhash64("value").alias("h"))
    # sums of both halves of the line hashes: partial sums in every task, whatever the file's size
    halves = [F.sum(F.shiftright("h", 32)), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)))]
    digest = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[h.cast("string") for h in halves])
    return listed.join(lines.groupBy("file").agg(digest.alias("content")), "file", "left").withColumn("content", F.coalesce("content", F.lit("0")))


def commits(spark: SparkSession, table: str) -> DataFrame:
    """(load_id, load_no) of the finished loads."""
    return spark.read.schema("load_id string, load_no long").parquet(f"{table}/commits") if storage.children(spark, f"{table}/commits") else spark.createDataFrame([], "load_id string, load_no long")


def history(spark: SparkSession, table: str) -> DataFrame:
    """The ledger of all finished loads: one row per load and file that it looked at."""
    if not storage.children(spark, f"{table}/ledger"):
        return spark.createDataFrame([], LEDGER)
    names = [f.split()[0] for f in LEDGER.split(", ")]
    return spark.read.schema(LEDGER).parquet(f"{table}/ledger").join(commits(spark, table).select("load_id"), "load_id", "left_semi").select(names)


def loaded_versions(spark: SparkSession, table: str) -> DataFrame:
    """One row per file: the newest version of it that is in the table."""
    rows = history(spark, table).where(F.col("status").isin(*LOADED))
    newest = rows.groupBy("file").agg(F.max_by(F.struct("size", "modified", "content", "load_no", "load_id"), "load_no").alias("v"))
    return newest.select("file", "v.*")


def pending(spark: SparkSession, path: str, table: str, identity: str = "stat") -> DataFrame:
    """Versions under ``path`` that are not the newest loaded ones."""
    known = loaded_versions(spark, table).select("file", *[F.col(c).alias(f"_{c}") for c in _VERSION[identity]], F.lit(True).alias("_known"))
    same = F.col("_known").isNotNull()
    for c in _VERSION[identity]:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    found = file_versions(spark, path, identity)
    return found.join(known, "file", "left").where(~same).select(found.columns)


def _literal(path: str) -> str:
    """A path that names one file even if its name holds signs of a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def load_new(
    spark: SparkSession,
    path: str,
    table: str,
    target: T.StructType,
    not_null: list[str] = (),
    max_len: dict[str, int] | None = None,
    multiline: bool = False,
    policy: str = "skip_file",
    identity: str = "stat",
) -> DataFrame:
    """Load the versions under ``path`` that the table does not hold yet; returns the rows this load added to the ledger.

    ``policy`` is ``skip_file`` or ``skip_row``.  A load that finds nothing to do writes nothing."""
    todo = stored(pending(spark, path, table, identity), "pending-files")
    paths = [_literal(r["path"]) for r in todo.select("path").collect()]
    load_id = f"load-{uuid.uuid4().hex[:12]}"  # a letter first: the folder's name stays text when it is read back
    if not paths:
        return spark.createDataFrame([], LEDGER)
    load_no = (commits(spark, table).agg(F.max("load_no")).first()[0] or 0) + 1
    flagged = warehouse.flagged_rows(spark, paths, target, not_null, max_len, multiline=multiline)
    warehouse.apply_policy(flagged, policy, keep_file=True).write.parquet(f"{table}/rows/load_id={load_id}")
    report = todo.drop("path").join(warehouse.load_report(flagged, policy), "file", "left")  # a file without rows has no report
    report = report.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("rows", "bad_rows")} | {"reasons": F.coalesce("reasons", F.lit("")), "status": F.coalesce("status", F.lit("loaded"))})
    report.withColumn("load_no", F.lit(load_no).cast("long")).write.parquet(f"{table}/ledger/load_id={load_id}")
    _commit(spark, table, load_id, load_no)
    return history(spark, table).where(F.col("load_id") == load_id)


def _commit(spark: SparkSession, table: str, load_id: str, load_no: int) -> None:
    """The one small write that makes a load count."""
    spark.createDataFrame([(load_id, load_no)], "load_id string, load_no long").coalesce(1).write.mode("append").parquet(f"{table}/commits")


def read_table(spark: SparkSession, table: str, target: T.StructType, versions: str = "newest") -> DataFrame:
    """Rows of the newest loaded version of every file, or of all loaded versions (``versions="all"``)."""
    if not storage.children(spark, f"{table}/commits"):
        return spark.createDataFrame([], target)
    if versions == "newest":
        wanted = loaded_versions(spark, table)
    else:
        wanted = history(spark, table).where(F.col("status").isin(*LOADED))
    layout = T.StructType([*target.fields, T.StructField(FILE, T.StringType()), T.StructField("load_id", T.StringType())])
    rows = spark.read.schema(layout).parquet(f"{table}/rows")
    return rows.join(wanted.select(F.col("file").alias(FILE), "load_id"), [FILE, "load_id"], "left_semi").select(*target.names)


def vacuum(spark: SparkSession, table: str, superseded: bool = False) -> list[str]:
    """Remove what unfinished loads left behind, and with ``superseded`` also the rows of loads whose files
    all have newer versions in the table (their ledger stays).  Returns the removed folders."""
    done = {r["load_id"] for r in commits(spark, table).collect()}  # one row a load
    needed = {r["load_id"] for r in loaded_versions(spark, table).select("load_id").distinct().collect()} if superseded else done
    gone = []
    for part, keep in (("rows", needed), ("ledger", done)):
        for name in storage.children(spark, f"{table}/{part}"):
            if name.startswith("load_id=") and name.removeprefix("load_id=") not in keep:
                storage.remove(spark, f"{table}/{part}/{name}")
                gone.append(f"{part}/{name}")
    return gone
