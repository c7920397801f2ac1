import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions import time, trip
from tripflow.operators import gold, silver

START = dt.datetime(2025, 6, 16, 8, 0, 0)
GOOD = {
    "VendorID": 1, "tpep_pickup_datetime": START, "tpep_dropoff_datetime": START + dt.timedelta(minutes=10),
    "passenger_count": 2, "trip_distance": 3.0, "RatecodeID": 1, "store_and_fwd_flag": "N", "PULocationID": 100,
    "DOLocationID": 200, "payment_type": 1, "fare_amount": 10.0, "extra": 1.0, "mta_tax": 0.5, "tip_amount": 2.0,
    "tolls_amount": 0.0, "improvement_surcharge": 1.0, "total_amount": 15.0, "congestion_surcharge": 2.5,
    "Airport_fee": 0.0, "cbd_congestion_fee": 0.75,
}


def bronze(spark, *changes):
    rows = [tuple({**GOOD, **change}[c] for c in schema.BRONZE.fieldNames()) for change in changes]
    return spark.createDataFrame(rows, schema.BRONZE)


def kept(spark, column, values):
    frame = bronze(spark, *[{column: v} for v in values])
    found = {r[0] for r in silver.clean(frame).select(column).collect()}
    return [v in found for v in values]


def test_range_filters(spark):
    nan = float("nan")
    assert kept(spark, "trip_distance", [0.0, 0.01, 59.99, 60.0, None]) == [False, True, True, False, False]
    assert kept(spark, "total_amount", [-0.01, 0.0, None]) == [False, True, False]
    assert kept(spark, "fare_amount", [0.0, 0.01, 499.99, 500.0, None]) == [False, True, True, False, False]
    for column in ("trip_distance", "total_amount", "fare_amount"):
        assert silver.clean(bronze(spark, {column: nan})).count() == 0


def test_duration_bounds(spark):
    ends = [dt.timedelta(0), dt.timedelta(seconds=1), dt.timedelta(seconds=10799), dt.timedelta(minutes=180)]
    frame = bronze(spark, *[{"tpep_dropoff_datetime": START + e} for e in ends])
    assert sorted(r[0] for r in silver.clean(frame).select(schema.TARGET).collect()) == [1 / 60.0, 10799 / 60.0]


def test_impute_and_clamp(spark):
    frame = bronze(spark, *[{"RatecodeID": v, "fare_amount": float(i + 1)} for i, v in enumerate([99, 0, 5, None])])
    found = silver.clean(frame).orderBy("fare_amount").select("RatecodeID").collect()
    assert [r[0] for r in found] == [6, 1, 5, 1]
    nulls = dict.fromkeys(["passenger_count", "congestion_surcharge", "Airport_fee", "store_and_fwd_flag"])
    row = silver.clean(bronze(spark, nulls)).first()
    assert (row.passenger_count, row.congestion_surcharge, row.Airport_fee, row.store_and_fwd_flag) == (1, 0.0, 0.0, "N")
    assert silver.clamp_rate_code(bronze(spark, {"RatecodeID": None})).first().RatecodeID is None


def test_tip_cap(spark):
    tips = spark.createDataFrame([(-1.0, 10.0), (25.0, 10.0), (20.0, 10.0), (None, 10.0)], "tip double, fare double")
    assert [r[0] for r in tips.select(trip.cap_tip(F.col("tip"), F.col("fare"))).collect()] == [0.0, 20.0, 20.0, None]


def test_missing_columns(spark):
    without_optional = bronze(spark, {}).drop("cbd_congestion_fee", "extra")
    row = silver.clean(without_optional).first()
    assert row.cbd_congestion_fee is None and silver.clean(without_optional).columns == schema.SILVER_COLUMNS
    with pytest.raises(ValueError, match="fare_amount"):
        silver.clean(bronze(spark, {}).drop("fare_amount"))


def test_time_parts_and_flags(spark):
    def stamps(*values):
        return spark.createDataFrame([(v,) for v in values], "ts timestamp_ntz")

    sunday, monday = dt.datetime(2025, 6, 15, 7), dt.datetime(2025, 6, 16, 7)
    found = stamps(sunday, monday).select(time.day_of_week(F.col("ts")), time.time_flags(F.col("ts"))["is_weekend"]).collect()
    assert [tuple(r) for r in found] == [(6, True), (0, False)]
    flags = lambda hours: [
        tuple(r) for r in stamps(*[dt.datetime(2025, 6, 16, h) for h in hours]).select(
            time.time_flags(F.col("ts"))["is_peak_hour"], time.time_flags(F.col("ts"))["is_night"]).collect()
    ]
    assert [f[0] for f in flags([7, 10, 11, 16, 19, 20])] == [True, True, False, True, True, False]
    assert [f[1] for f in flags([21, 22, 5, 6])] == [False, True, True, False]
    # 1 January 2023 is in ISO week 52 of the year before, but the year stays 2023.
    parts = time.time_parts(F.col("ts"))
    assert tuple(stamps(dt.datetime(2023, 1, 1)).select(parts["pickup_week_of_year"], parts["pickup_year"]).first()) == (52, 2023)


def test_epoch_ignores_session_zone(spark):
    # 02:30 does not exist in New York on that night.
    frame = spark.createDataFrame([(dt.datetime(2025, 3, 9, 1, 30), dt.datetime(2025, 3, 9, 3, 30))], "a timestamp_ntz, b timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert frame.select(time.duration_minutes(F.col("a"), F.col("b"))).first()[0] == 120.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ratios_without_denominator(spark):
    row = silver.with_duration(bronze(spark, {"total_amount": 0.0, "trip_distance": 0.0})).withColumns(trip.fare_ratios()).first()
    assert (row.surcharge_ratio, row.toll_ratio, row.fare_per_mile) == (None, None, None)
    row = silver.with_duration(bronze(spark, {"tolls_amount": None, "extra": None})).withColumns({**trip.fare_ratios(), **trip.fee_flags()}).first()
    assert row.toll_ratio is None and row.has_tolls == 0
    assert row.surcharge_ratio == (0.0 + 2.5 + 0.0 + 0.75) / 15.0


def test_gold_counts_and_null_zone(spark):
    may = dt.datetime(2025, 5, 1)
    frame = bronze(
        spark,
        {}, {}, {"DOLocationID": 237},
        {"PULocationID": None, "DOLocationID": 237}, {"PULocationID": 237, "DOLocationID": None},
        {"tpep_pickup_datetime": may, "tpep_dropoff_datetime": may + dt.timedelta(minutes=5)},
    )
    result = gold.engineer(silver.clean(frame))
    assert len(result.columns) == 49
    rows = {
        (r.PULocationID, r.DOLocationID, r.pickup_month): (
            r.pickup_zone_trip_count, r.dropoff_zone_trip_count, r.route_trip_count, r.route_id, r.is_same_zone)
        for r in result.collect()
    }
    assert result.count() == 6
    assert rows[100, 200, 6] == (3, 2, 2, "100_200", False)
    assert rows[100, 200, 5] == (1, 1, 1, "100_200", False)
    # No count for a null zone; the two half-known routes share one text and one count.
    assert rows[None, 237, 6] == (None, 2, 2, "237", None)
    assert rows[237, None, 6] == (1, None, 2, "237", None)


def test_cyclical(spark):
    row = gold.time_features(bronze(spark, {"tpep_pickup_datetime": dt.datetime(2025, 6, 16, 6)})).first()
    assert math.isclose(row.sin_hour, 1.0) and abs(row.cos_hour) < 1e-12 and row.cos_day_of_week == 1.0
