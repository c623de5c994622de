import pytest
from pyspark.sql import functions as F

from usagelens.llm import queries
from usagelens.llm.merkle_manifest import folded, leaf_digest, manifest, proof_digest

from .brute import manifest as brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, rank long, path string, size int"


def run(spark, rows, folder):
    spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in queries.QUERIES["op12_merkle_manifest"](spark, folder).select(names).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, "b": 17}, {"a": 300, None: 3, "": 1, "é": 33, "z": 256, "Z": 1}, {f"s{i}": i % 3 + 1 for i in range(40)}])
def test_trees(spark, tmp_dir, sizes):
    rows = [(1000 * k + i, f"Text {i} ÀB", "en", s, 5) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    assert run(spark, rows, tmp_dir) == brute(rows)


def test_edges(spark, tmp_dir):
    rows = [(1, None, None, None, None), (1, "", "", "", 0), (None, "A", "en", "s", 1), (None, None, None, "s", None), (5, "Zz", "en", "s", 2), (5, "Zz", "en", "s", 2), (5, "other", None, "s", 2)]
    rows += [(10, "Long TEXT " * 300_000, "en", "s", 3_000_000)] + [(7, "same row", "en", "s", 8)] * 40
    assert run(spark, rows, tmp_dir) == brute(rows)


def test_empty(spark, tmp_dir):
    assert run(spark, [], tmp_dir) == []


def test_many_partitions_of_one_group(spark, tmp_dir):
    """A group cut over many partitions has the same ranks as a whole one."""
    rows = [(i, f"T{i}", "en", "hot" if i % 3 else f"s{i % 7}", i) for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert run(spark, rows, tmp_dir) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_proofs_without_tampering(spark):
    """The general interface: any group, id and leaf columns; every proof leads to the root, and a changed leaf does not."""
    frame = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), leaf_digest([F.col("id")]).alias("h"), F.lit("kept").alias("more"))
    found = manifest(frame, "g", "k", "h").cache()
    assert found.columns == ["k", "g", "h", "more", "subroot", "root", "path"]
    assert found.select("root").distinct().count() == 1 and found.select("g", "subroot").distinct().count() == 3
    assert found.filter(folded(F.col("h"), F.col("path")) == F.col("root")).count() == 100
    assert found.filter(folded(F.sha2(F.lit("forged"), 256), F.col("path")) == F.col("root")).count() == 0
    assert found.select(proof_digest(F.col("path"))).distinct().count() == 100
    found.unpersist()
