"""The corpus pipeline: documents in, packed sequences out, one operator a stage.

Each stage takes ``(spark, docs, sf_dir)``, works on every row its predecessor
kept and returns the columns of ``documents`` (the last returns packed pieces).
``run`` writes each stage's rows as Parquet in the shared checkpoint folder and
rereads them as the next stage's documents.  An empty table passes through all
stages; null texts count as empty ones, and rows with null or repeated ids are
documents like any others (see each operator).  Texts of any length pass whole; what
a task holds of a long one is said by each operator.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm.decontaminate import drop_contaminated
from usagelens.llm.ngram_join import keep_one
from usagelens.llm.packing import pack
from usagelens.llm.quality_gam import keep_good
from usagelens.llm.queries import END_ID, QUALITY_CUT, tokenizer_file
from usagelens.llm.secret_scan import redact
from usagelens.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, trained on the labels of ``sf_dir``, does not reject."""
    return keep_good(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"), QUALITY_CUT)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles (Jaccard 0.8 or more): the smallest id."""
    return keep_one(docs).select(COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked (and ``n_chars`` of those texts counted anew)."""
    masked = redact(docs.withColumn("_before", F.col("text")), pieces=True)
    changed = ~F.col("text").eqNullSafe(F.col("_before"))
    return masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut and pack the token ids of all documents that are left."""
    return pack(docs, tokenizer_file(), end_id=END_ID)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", pack_sequences),
]

#: Trained models decide in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
