"""Expressions over distance, zone and money columns of a trip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: silver ranges and limits ---
MAX_DURATION_MIN = 180
MAX_DISTANCE = 60
MAX_FARE = 500
RATE_CODES = (1, 6)
MAX_TIP_PER_FARE = 2
SHORT_TRIP_MILES = 1
LONG_TRIP_MILES = 10


def clamp(value: Column, low: float, high: float) -> Column:
    """Value limited to [low, high]; null stays null (``greatest``/``least`` would skip it)."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def cap_tip(tip: Column, fare: Column) -> Column:
    """Tip limited to [0, 2 × fare]; a null tip stays null."""
    most = fare * F.lit(float(MAX_TIP_PER_FARE))
    return F.when(tip < 0, F.lit(0.0)).when(tip > most, most).otherwise(tip)


def open_range(value: Column, low: float, high: float | None = None) -> Column:
    """True for low < value < high; null and NaN are out (NaN sorts above every number)."""
    inside = (value > low) if high is None else (value > low) & (value < high)
    return value.isNotNull() & ~F.isnan(value) & inside


def at_least(value: Column, low: float) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (value >= low)


def distance_features(distance: Column) -> dict[str, Column]:
    return {
        "is_short_trip": distance < SHORT_TRIP_MILES,
        "is_long_trip": distance > LONG_TRIP_MILES,
        "log_trip_distance": F.log1p(distance),
        "sqrt_trip_distance": F.sqrt(distance),
    }


def route_features(pickup_zone: Column, dropoff_zone: Column) -> dict[str, Column]:
    """Route text skips a null zone; ``is_same_zone`` is null when either zone is."""
    return {
        "route_id": F.concat_ws("_", pickup_zone.cast("int").cast("string"), dropoff_zone.cast("int").cast("string")),
        "is_same_zone": pickup_zone.cast("int") == dropoff_zone.cast("int"),
    }


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def fare_ratios() -> dict[str, Column]:
    total = F.col("total_amount")
    surcharges = (
        _or_zero("extra") + _or_zero("congestion_surcharge") + _or_zero("Airport_fee") + _or_zero("cbd_congestion_fee")
    )
    return {
        "fare_per_mile": F.when(
            F.col("trip_distance") > 0, F.try_divide(F.col("fare_amount"), F.col("trip_distance"))
        ),
        "surcharge_ratio": F.try_divide(surcharges, total),
        "toll_ratio": F.try_divide(F.col("tolls_amount"), total),
    }


def fee_flags() -> dict[str, Column]:
    return {
        "has_tolls": (_or_zero("tolls_amount") > 0).cast("int"),
        "has_airport_fee": (_or_zero("Airport_fee") > 0).cast("int"),
        "has_congestion_fee": (_or_zero("congestion_surcharge") > 0).cast("int"),
    }
