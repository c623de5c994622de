"""Bounded samples of labelled documents for the operators that train a model."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm._common import held_out


def one_text(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of ``keys`` and text for each key: of its texts the one with the smallest hash, whatever their number."""
    return rows.groupBy(*keys).agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, float]:
    """(text, y) of at most ``most`` labelled documents outside the held-out fold, and the log odds that the sample lacks.

    If there are more, all rows of the rarer class are taken up to half of
    ``most``, and the rest from the other class: those with the smallest hash of
    their id, so the sample is the same in every run; its size bounds what is
    broadcast here and collected by the caller.  Added to the log odds of a model
    fitted on the sample, the second result puts back the classes' true share.
    Ids or labels that are null are left out; an id that is labelled twice counts
    once, by its larger label, and of rows that repeat an id the one whose text has
    the smallest hash: never more than ``most`` rows.
    """
    usable = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
    usable = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("double").alias("y"))
    positive = F.coalesce(F.col("y") > 0.5, F.lit(False))
    there = {r["positive"]: r["n"] for r in usable.groupBy(positive.alias("positive")).agg(F.count("*").alias("n")).collect()}
    rarer = there.get(True, 0) <= there.get(False, 0)
    few, many = there.get(rarer, 0), there.get(not rarer, 0)
    taken = {rarer: min(few, max(most // 2, most - many))}
    taken[not rarer] = min(many, most - taken[rarer])
    draw = lambda side: usable.filter(positive if side else ~positive).orderBy(F.xxhash64("_id"), "_id").limit(taken[side])
    sample = draw(True).unionByName(draw(False))
    lacking = math.log(there[True] / taken[True]) - math.log(there[False] / taken[False]) if all(taken.values()) else 0.0
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "_id")
    rows = one_text(rows, ["_id", "y"]).select("text", "y")
    return rows, lacking
