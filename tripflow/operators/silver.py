"""Cleaning of bronze trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions import time, trip


def with_all_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The declared projection; optional columns a source lacks become typed nulls."""
    missing = [c for c in schema.REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.BRONZE
        ],
        *keep,
    )


def with_duration(df: DataFrame) -> DataFrame:
    return df.withColumn(schema.TARGET, time.duration_minutes(F.col(schema.PICKUP), F.col(schema.DROPOFF)))


def keep_valid(df: DataFrame) -> DataFrame:
    """Range filters. Those on stored columns come first, as the scan can apply them.

    NaN is rejected everywhere, also for ``total_amount``.
    """
    return (
        df.where(trip.open_range(F.col("trip_distance"), 0, trip.MAX_DISTANCE))
        .where(trip.open_range(F.col("fare_amount"), 0, trip.MAX_FARE))
        .where(trip.at_least(F.col("total_amount"), 0))
        .where(trip.open_range(F.col(schema.TARGET), 0, trip.MAX_DURATION_MIN))
    )


def impute_defaults(df: DataFrame) -> DataFrame:
    return df.na.fill({c: v for c, v in schema.NULL_DEFAULTS.items() if c in df.columns})


def clamp_rate_code(df: DataFrame) -> DataFrame:
    return df.withColumn("RatecodeID", trip.clamp(F.col("RatecodeID"), *trip.RATE_CODES))


def cap_tip(df: DataFrame) -> DataFrame:
    return df.withColumn("tip_amount", trip.cap_tip(F.col("tip_amount"), F.col("fare_amount")))


def clean(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Bronze to silver: 21 columns, valid rows, imputed and limited values. Narrow, no shuffle.

    ``keep`` names further source columns to carry along, such as a row key.
    """
    valid = keep_valid(with_duration(with_all_columns(bronze, keep)))
    return cap_tip(clamp_rate_code(impute_defaults(valid)))
