"""Normalisation of activity rows: timestamp parsing, calendar columns, cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens import schemas
from usagelens.functions.dates import calendar_year, iso_week, iso_year, parse_timestamp
from usagelens.functions.scalars import clamp


def normalize_events(raw: DataFrame) -> DataFrame:
    """Typed activity rows: timestamp parsed (bad -> NULL, row kept)."""
    cols = [f.name for f in schemas.ACTIVITY.fields]
    return raw.withColumn("timestamp", parse_timestamp("timestamp")).select(*cols)


def add_calendar(df: DataFrame, iso: bool = False) -> DataFrame:
    """Add date, ISO week and year.

    ``iso=False`` pairs the ISO week with the *calendar* year, as the metric
    tables always did (2024-12-30 -> (2024, 1)); ``iso=True`` uses the ISO year.
    """
    ts = F.col("timestamp")
    year = iso_year(ts) if iso else calendar_year(ts)
    return df.withColumns({"date": F.to_date(ts), "week": iso_week(ts), "year": year})


def events_normalized(raw: DataFrame) -> DataFrame:
    """Raw log rows -> fact rows (raw columns + date, week, year)."""
    return add_calendar(normalize_events(raw))


def drop_null_timestamps(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["timestamp"])


def clamp_sessions(df: DataFrame, lo: int = schemas.SESSION_MIN_SEC, hi: int = schemas.SESSION_MAX_SEC) -> DataFrame:
    return df.withColumn("session_length", clamp("session_length", lo, hi))
