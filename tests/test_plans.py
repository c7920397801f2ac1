import re
import sys
from pathlib import Path

import pytest
from conftest import final_plan, formatted_plan
from pyspark.sql import functions as F

from tripflow import fixtures, schema
from tripflow.operators import drift, gold, ordered, silver, split
from tripflow.plans import oracles
from tripflow.plans.oracles import ORACLES
from tripflow.plans.queries import QUERIES
from tripflow.sources import storage

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import check  # noqa: E402

ONE_TASK_WINDOW = re.compile(r"windowspecdefinition\([^,]*\b(ASC|DESC)\b")
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


@pytest.fixture(scope="module")
def bronze(spark, sf):
    path = storage.shared_path(spark, "bronze")
    storage.write_layer(storage.with_month(fixtures.trips(spark, sf)), path, rebalance=True)
    return storage.scan_layer(spark, path)


def assert_sound(plan: str) -> None:
    for node in FORBIDDEN:
        assert node not in plan
    assert not ONE_TASK_WINDOW.search(plan)


def test_silver_pushes_filters_and_does_not_shuffle(spark, bronze):
    cleaned = silver.clean(bronze).select("trip_distance", schema.TARGET)
    plan = final_plan(cleaned)
    assert_sound(plan)
    text = formatted_plan(cleaned)
    pushed = re.search(r"PushedFilters: \[(.*?)\]\s+ReadSchema: struct<(.*?)>", text)
    for wanted in ("GreaterThan(trip_distance,0.0)", "LessThan(trip_distance,60.0)", "GreaterThan(fare_amount,0.0)",
                   "GreaterThanOrEqual(total_amount,0.0)"):
        assert wanted in pushed.group(1)
    read = {c.split(":")[0] for c in pushed.group(2).split(",")}
    assert read == {"trip_distance", "fare_amount", "total_amount", schema.PICKUP, schema.DROPOFF}
    assert "Exchange" not in plan


def test_month_filter_prunes_partitions(spark, bronze):
    plan = final_plan(silver.clean(bronze.where("year = 1997 AND month = 3")))
    assert re.search(r"PartitionFilters: \[.*year#\d+ = 1997.*month#\d+ = 3", plan)


def test_refresh_scans_only_pending_months(spark, bronze):
    months = bronze.where("year = 1995 AND month IN (2, 5) OR year = 1996 AND month = 1").select("year", "month").distinct().collect()
    pruned = bronze.where(storage.months_condition(months))
    assert {(r.year, r.month) for r in pruned.select("year", "month").distinct().collect()} == {(1995, 2), (1995, 5), (1996, 1)}
    scan = re.search(r"PartitionFilters: \[(.*)\]", formatted_plan(pruned)).group(1)
    assert "1995" in scan and "1996" in scan


def test_count_lookup_scans_trips_once(spark, bronze):
    plan = final_plan(gold.count_lookup(silver.clean(bronze)))
    assert_sound(plan)
    assert schema.PICKUP not in plan


def test_gold_joins_once_and_broadcasts_a_small_lookup(spark, bronze):
    plan = final_plan(gold.engineer(silver.clean(bronze)))
    assert_sound(plan)
    assert plan.split("Initial Plan")[0].count("BroadcastHashJoin") == 1
    assert "SortMergeJoin" not in plan


def test_large_lookup_shuffles_no_derived_columns(spark, bronze):
    """Past the broadcast limit the trips are shuffled as they are in silver, and sorted by a key that tells pairs apart."""
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for key in limits:
            spark.conf.set(key, "-1")
        joined = final_plan(gold.engineer(silver.clean(bronze))).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    above, below = joined.split("SortMergeJoin", 1)
    assert "AS pickup_hour" in above and "pickup_hour" not in below
    assert re.search(r"Sort \[coalesce\(PULocationID", below)


def test_large_lookup_shuffles_and_splits_a_hot_pair(spark):
    """Past the broadcast limit: a sort-merge join in which AQE cuts the hot pair's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    # A third and more of all trips go between the same two zones.
    zone = F.when(F.col("id") % 5 < 2, 1).otherwise(F.col("id") % 97)
    trips = spark.range(0, 60000, 1, 8).select(
        F.lit(2025).alias("pickup_year"), F.lit(1).alias("pickup_month"), zone.alias("PULocationID"), zone.alias("DOLocationID"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    lookup = storage.written(
        trips.groupBy("pickup_year", "pickup_month", "PULocationID", "DOLocationID").agg(F.count("*").alias("route_trip_count")), "lookup")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = gold.with_counts(trips, lookup)
        plan = final_plan(joined)
        assert "SortMergeJoin(skew=true)" in plan
        counts = joined.where("PULocationID = 1").select("route_trip_count").distinct().collect()
        assert len(counts) == 1 and counts[0][0] == trips.where("PULocationID = 1").count()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["scaling_stats", "scale_features"])
def test_scaling_joins_lines_and_orders_once(spark, sf, name):
    """What follows reads the written trips."""
    assert "o_orderdate" not in formatted_plan(QUERIES[name](spark, sf))


def test_running_counts_and_split_have_no_one_task_sort(spark, bronze):
    trips = silver.clean(bronze)
    frequencies = storage.written(
        trips.groupBy(F.lit("d").alias("g"), F.col("trip_distance").alias("v")).agg(F.count("*").alias("n")), "f")
    plan = final_plan(ordered.running_counts(frequencies, "g", "v", ["n"]))
    assert_sound(plan)
    assert "ReusedExchange" in plan
    plan = final_plan(split.time_split(trips))
    assert_sound(plan)


def test_drift_reads_only_the_frequency_table(spark, bronze):
    trips = silver.clean(bronze).withColumn("is_reference", F.year(schema.PICKUP) <= 1998)
    columns = drift.drift_columns(drift.column_frequencies(trips, ["trip_distance", "fare_amount"], ["payment_type"]))
    plan = final_plan(columns)
    assert_sound(plan)
    assert "tpep_pickup_datetime" not in plan


CHECKED = [
    "zone_hour_summary", "silver_trips", "gold_trips", "route_trip_counts", "rule_violations", "quarantine_trips",
    "profile_columns", "validate_columns", "pending_partitions", "refresh_layer", "sample_rows", "target_means", "ml_table",
    "regression_metrics", "compare_models", "quality_gate", "drift_columns", "drift_chi2", "validate_requests",
    "request_features", "request_rate_5m", "latency_quantiles", "prediction_shift_1h", "monitor_stream",
    "refresh_replaced", "stage_records", "land_months", "scaling_stats", "scale_features", "validate_counts", "drift_summary",
    "profile_table",
]


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    assert check.differences(df, rows, check.connect(sf), ORACLES[name]) == []


def test_all_scaled_columns_match_sql(spark, sf):
    scaled = ", ".join(f"{oracles.r(f'({c} - {c}_mean) / {c}_std')} AS {c}" for c in schema.SCALED_COLUMNS)
    stats = oracles._scaling("gold", "TRUE", schema.SCALED_COLUMNS)
    expected = {
        "scaling_stats": oracles.over(
            "gold", f'SELECT "column", {oracles.r("mean")} AS mean, {oracles.r("stddev")} AS stddev FROM ({stats})'),
        "scale_features": oracles.over(
            "gold_split", f"SELECT {oracles.KEY}, {scaled} FROM gold_split CROSS JOIN stats",
            stats=oracles._stats(schema.SCALED_COLUMNS, "gold_split")),
    }
    for name, sql in expected.items():
        df = QUERIES[name](spark, sf)
        assert check.differences(df, [tuple(r) for r in df.collect()], check.connect(sf), sql) == []


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
