"""Join helpers: a hint only for sides bounded by construction; Spark picks the rest from measured sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (e.g. built from
    parameters, one row per partition, or a one-row aggregate)."""
    return F.broadcast(df)
