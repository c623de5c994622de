"""Small metadata helpers on DataFrame column lists (driver-side, no data)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def require(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def matching(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name matches a regex, in frame order."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def key_first_sorted(df: DataFrame, key: str) -> DataFrame:
    """Key column first, every other column in case-sensitive name order."""
    return df.select(key, *sorted(c for c in df.columns if c != key))


def common_and_unique(a: list[str], b: list[str]) -> tuple[list[str], list[str], list[str]]:
    """(common, only in a, only in b), each sorted for a deterministic order."""
    sa, sb = set(a), set(b)
    return sorted(sa & sb), sorted(sa - sb), sorted(sb - sa)
