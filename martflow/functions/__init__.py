"""Column expressions (built-in functions only, so they stay in codegen)."""

from martflow.functions.calendar import (  # noqa: F401
    calendar_columns, day_type, half_year, is_weekend, season, time_key, weekday_name,
)
from martflow.functions.measures import pct_change, revenue  # noqa: F401
