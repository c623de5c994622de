"""Scalar column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(c: Column | str, lo, hi) -> Column:
    """Bound a value to [lo, hi]; NULL stays NULL (greatest/least alone skip NULLs)."""
    col = _c(c)
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(lo)), F.lit(hi)))


def nan_to_null(c: Column | str) -> Column:
    """Spark keeps NaN apart from NULL (and sum over NaN is NaN); map NaN to NULL at ingest."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def differs(a: Column | str, b: Column | str) -> Column:
    """True when both sides are present and unequal (NULL on either side -> False)."""
    a, b = _c(a), _c(b)
    return F.coalesce(a != b, F.lit(False))


def prefixed(names: list[str], prefix: str = "", suffix: str = "") -> list[str]:
    return [f"{prefix}{n}{suffix}" for n in names]
