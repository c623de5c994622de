"""Folders and single files in whatever store the paths name (through Hadoop's file-system API)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagelens.session import scratch_path
from usagelens.sources import files


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def write_csv_file(df: DataFrame, path: str) -> None:
    """``df`` as one CSV file at exactly ``path``, which it replaces (one file is one task's work)."""
    spark = df.sparkSession
    folder = scratch_path(spark, "one-file")
    files.write_csv(df.coalesce(1), folder)
    part = next(n for n in children(spark, folder) if n.startswith("part-"))
    fs, target = _at(spark, path)
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(_at(spark, f"{folder}/{part}")[1], target):
        raise OSError(f"cannot move the written file to {path}")
    remove(spark, folder)
