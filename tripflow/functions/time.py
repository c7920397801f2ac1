"""Expressions over pickup and dropoff timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
WEEKEND_DAYS = [5, 6]
PEAK_HOURS = [7, 8, 9, 10, 16, 17, 18, 19]
NIGHT_HOURS = [22, 23, 0, 1, 2, 3, 4, 5]


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970; zone-free timestamps give the same number in any session zone."""
    return F.unix_timestamp(ts)


def duration_minutes(start: Column, end: Column) -> Column:
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def day_of_week(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ts)


def time_parts(ts: Column) -> dict[str, Column]:
    """Calendar parts. The ISO week goes with the calendar year, so 1 January may be week 52 or 53."""
    return {
        "pickup_hour": F.hour(ts),
        "pickup_day_of_month": F.dayofmonth(ts),
        "pickup_week_of_year": F.weekofyear(ts),
        "pickup_month": F.month(ts),
        "pickup_year": F.year(ts),
        "pickup_day_of_week": day_of_week(ts),
    }


def time_flags(ts: Column) -> dict[str, Column]:
    hour = F.hour(ts)
    peak = hour.isin(PEAK_HOURS)
    return {
        "is_weekend": day_of_week(ts).isin(WEEKEND_DAYS),
        "is_peak_hour": peak,
        "is_night": hour.isin(NIGHT_HOURS),
        "is_rush_hour": peak,
    }


def cyclical_time(ts: Column) -> dict[str, Column]:
    hour_angle = F.lit(2.0 * math.pi) * F.hour(ts) / F.lit(24.0)
    day_angle = F.lit(2.0 * math.pi) * day_of_week(ts) / F.lit(7.0)
    return {
        "sin_hour": F.sin(hour_angle),
        "cos_hour": F.cos(hour_angle),
        "sin_day_of_week": F.sin(day_angle),
        "cos_day_of_week": F.cos(day_angle),
    }
