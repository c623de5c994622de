from usagelens.functions.dates import (  # noqa: F401
    calendar_year,
    days_between,
    iso_week,
    iso_year,
    parse_timestamp,
    week_monday,
    week_start_from_parts,
)
from usagelens.functions.scalars import clamp, differs, nan_to_null  # noqa: F401
