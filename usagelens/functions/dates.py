"""Date / time column expressions (all built-in, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str) -> Column:
    """Text or timestamp -> TIMESTAMP_NTZ; an unparsable value becomes NULL (row kept)."""
    return _c(c).try_cast("timestamp_ntz")


def iso_week(c: Column | str) -> Column:
    """ISO-8601 week number 1..53 (weeks start Monday, week 1 holds the first Thursday)."""
    return F.weekofyear(_c(c)).cast("int")


def calendar_year(c: Column | str) -> Column:
    return F.year(_c(c)).cast("int")


def iso_year(c: Column | str) -> Column:
    """The year an ISO week belongs to (differs from the calendar year near 1 January)."""
    return F.extract(F.lit("YEAROFWEEK"), _c(c)).cast("int")


def week_monday(c: Column | str) -> Column:
    """Monday of the (ISO) week holding the date."""
    return F.to_date(F.date_trunc("week", _c(c)))


def week_start_from_parts(year: Column | str, week: Column | str) -> Column:
    """Warehouse rule for a week's start date: from 1 January of ``year`` go
    ``(week - 1) * 7`` days forward, then back to the Monday on or before 1 January.

    Matches true Mondays only when 1 January falls on Monday..Thursday; kept as is
    because loaded tables carry this value.
    """
    jan1 = F.make_date(_c(year), F.lit(1), F.lit(1))
    # weekday(): Monday = 0 .. Sunday = 6
    return F.date_add(jan1, (_c(week) - 1) * 7 - F.weekday(jan1))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_c(later), _c(earlier))


def strict_date(col: Column | str) -> Column:
    """Date from ISO text; a value that is no date stops the job (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    date = F.try_to_date(c, "yyyy-MM-dd")
    bad = c.isNotNull() & date.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a date: "), c)).cast("date")).otherwise(date)
