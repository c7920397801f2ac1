"""Feature engineering on silver trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions import time, trip
from tripflow.sources.storage import written

MONTH = ["pickup_year", "pickup_month"]
ZONES = ["PULocationID", "DOLocationID"]
COUNTS = ["pickup_zone_trip_count", "dropoff_zone_trip_count", "route_trip_count"]


def time_features(df: DataFrame, ts: str = schema.PICKUP) -> DataFrame:
    pickup = F.col(ts)
    return df.withColumns({**time.time_parts(pickup), **time.time_flags(pickup), **time.cyclical_time(pickup)})


def distance_features(df: DataFrame) -> DataFrame:
    return df.withColumns(trip.distance_features(F.col("trip_distance")))


def route_features(df: DataFrame) -> DataFrame:
    pickup, dropoff = F.col("PULocationID"), F.col("DOLocationID")
    return df.withColumns(
        {
            **trip.route_features(pickup, dropoff),
            "PULocationID": pickup.cast("int"),
            "DOLocationID": dropoff.cast("int"),
        }
    )


def fare_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            **trip.fare_ratios(),
            **trip.fee_flags(),
            "non_fare_amount": F.col("total_amount") - F.col("fare_amount"),
        }
    )


def _keyed(silver: DataFrame) -> DataFrame:
    return route_features(
        silver.select(
            F.year(schema.PICKUP).alias("pickup_year"),
            F.month(schema.PICKUP).alias("pickup_month"),
            *ZONES,
        )
    )


def pair_counts(silver: DataFrame) -> DataFrame:
    """Trips per month and zone pair: the one aggregate that all three counts of the lookup derive from."""
    return _keyed(silver).groupBy(*MONTH, *ZONES).agg(F.count("*").alias("trips"))


def zone_trip_counts(silver: DataFrame, zone: str, name: str) -> DataFrame:
    return _keyed(silver).groupBy(*MONTH, zone).agg(F.count("*").alias(name))


def route_trip_counts(silver: DataFrame) -> DataFrame:
    return _keyed(silver).groupBy(*MONTH, "route_id").agg(F.count("*").alias("route_trip_count"))


def count_lookup(silver: DataFrame) -> DataFrame:
    """The three counts for each month and zone pair, one row per pair.

    A null zone has no count. Two pairs share a route text only where one zone is null ('237' from a null pickup or a null
    dropoff), so only those are counted per text; the text of two known zones is theirs alone.

    With many zones there are nearly as many pairs as trips. They are shuffled once, for the sums per pickup zone: a window
    whose groups hold a row per dropoff zone. The other two sums are small tables.
    """
    # Written: each of the uses below would otherwise scan and shuffle the trips again.
    pairs = written(pair_counts(silver), "pair-counts")
    known = pairs.where("DOLocationID IS NOT NULL")
    dropoffs = known.groupBy(*MONTH, "DOLocationID").agg(F.sum("trips").alias("dropoff_zone_trip_count"))
    half_known = route_features(pairs.where("PULocationID IS NULL OR DOLocationID IS NULL"))
    texts = half_known.groupBy(*MONTH, "route_id").agg(F.sum("trips").alias("_text_trips"))
    # The zone comes first, as rows are sorted in this order and a zone tells more of them apart.
    of_pickup = F.sum("trips").over(Window.partitionBy("PULocationID", *MONTH))
    both = F.col("PULocationID").isNotNull() & F.col("DOLocationID").isNotNull()
    summed = route_features(pairs.withColumn("pickup_zone_trip_count", F.when(F.col("PULocationID").isNotNull(), of_pickup)))
    return (
        # No text to look for where both zones are known.
        summed.withColumn("route_id", F.when(~both, F.col("route_id")))
        .join(written(dropoffs, "dropoff-counts"), [*MONTH, "DOLocationID"], "left")
        .join(written(texts, "text-counts"), [*MONTH, "route_id"], "left")
        .withColumn("route_trip_count", F.when(both, F.col("trips")).otherwise(F.col("_text_trips")))
        .select(*MONTH, *ZONES, *COUNTS)
    )


def with_counts(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """One null-safe join for all three counts instead of three joins.

    The lookup is a written table: it is broadcast while its files are small; beyond that the
    trips shuffle once, and AQE splits a hot pair because the trips are the streamed side. The zones come
    first among the keys, as rows are sorted in this order, and a year or a month tells few apart.
    """
    keys = [*ZONES, *MONTH]
    right = lookup.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [df[k].eqNullSafe(right[f"_{k}"]) for k in keys]
    return df.join(right, same, "left").drop(*[f"_{k}" for k in keys])


def engineer(silver: DataFrame) -> DataFrame:
    """Silver to gold: 30 new columns, two dropped. Counts cover the whole month, later splits included."""
    lookup = written(count_lookup(silver), "trip-counts")
    # The counts are joined first: beyond the broadcast limit the trips are shuffled, without the columns derived below.
    months = dict(zip(MONTH, (F.year(schema.PICKUP), F.month(schema.PICKUP))))
    counted = with_counts(silver.withColumns({**months, **{z: F.col(z).cast("int") for z in ZONES}}), lookup)
    order = _features(silver).columns
    return _features(counted).select(*order, *COUNTS).drop(schema.DROPOFF, "total_amount")


def _features(df: DataFrame) -> DataFrame:
    return fare_features(route_features(distance_features(time_features(df))))
