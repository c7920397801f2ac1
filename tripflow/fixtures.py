"""Trip, request, stage-run and prediction-log views over the star-schema tables.

The column texts are plain SQL that Spark and other engines read alike, so the
checking SQL in ``tripflow.plans.oracles`` is built from the same texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.sources.storage import spread

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]

_OFFSET = "(l_orderkey * 7919 + l_linenumber * 3571) % 86400"
_FARE = "l_extendedprice / 200e0 - 10e0"

TRIP_COLUMNS = {
    "VendorID": "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 6 END",
    "tpep_pickup_datetime": f"o_orderdate + ({_OFFSET}) * INTERVAL '1' SECOND",
    "tpep_dropoff_datetime": f"o_orderdate + ({_OFFSET} + (l_partkey * 37 + l_linenumber * 613) % 12600 - 600)"
    " * INTERVAL '1' SECOND",
    "passenger_count": "NULLIF(l_partkey % 7, 0)",
    "trip_distance": "l_quantity * 1.3e0 - 1.3e0",
    "RatecodeID": "CASE l_linenumber WHEN 7 THEN 99 WHEN 6 THEN"
    " (CASE WHEN l_partkey % 2 = 0 THEN 0 ELSE NULL END) ELSE l_linenumber END",
    "store_and_fwd_flag": "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE NULL END",
    "PULocationID": "l_suppkey",
    "DOLocationID": "(o_custkey * 7) % 100",
    "payment_type": "CAST(SUBSTRING(o_orderpriority, 1, 1) AS INT) - 1",
    "fare_amount": _FARE,
    "extra": "CASE WHEN l_linenumber <= 2 THEN 2.5e0 ELSE NULL END",
    "mta_tax": "0.5e0",
    "tip_amount": f"({_FARE}) * (l_discount * 30e0 - 0.5e0)",
    "tolls_amount": "CASE WHEN l_tax > 0.06e0 THEN 6.55e0 ELSE 0e0 END",
    "improvement_surcharge": "1e0",
    "total_amount": f"({_FARE}) * (1e0 + l_tax)",
    "congestion_surcharge": "CASE WHEN l_linenumber % 2 = 0 THEN 2.5e0 ELSE NULL END",
    "Airport_fee": "CASE WHEN l_suppkey % 10 = 0 THEN 1.75e0 ELSE NULL END",
    "cbd_congestion_fee": "CASE WHEN l_suppkey < 20 THEN 0.75e0 ELSE 0e0 END",
}

# Together these four identify a trip.
TRIP_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

PREDICTION_LOG_COLUMNS = {
    "event_id": "event_id",
    "segment": "user_id",
    "ts": "ts",
    "endpoint": "CASE WHEN event_type = 'purchase' THEN '/predict/batch' ELSE '/predict' END",
    "error_type": "CASE WHEN event_type <> 'error' THEN NULL"
    " WHEN event_id % 3 = 0 THEN 'ValueError' ELSE 'KeyError' END",
    "latency_s": "value / 100e0",
    "prediction_min": "CASE WHEN event_type = 'error' THEN NULL ELSE value END",
    "batch_size": "CASE WHEN event_type = 'purchase' THEN 5 + event_id % 16 ELSE 1 END",
}

# One row per request as it arrives: text values, some absent, some out of bounds.
REQUEST_COLUMNS = {
    "pickup_datetime": "CASE WHEN l_partkey % 50 = 0 THEN 'not a date'"
    f" ELSE CAST(o_orderdate + ({_OFFSET}) * INTERVAL '1' SECOND AS VARCHAR(30)) END",
    "PULocationID": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_suppkey END",
    "DOLocationID": "(o_custkey * 7) % 100",
    "trip_distance": "l_quantity * 1.3e0 - 3.9e0",
    "passenger_count": "NULLIF(l_partkey % 12, 0)",
    "VendorID": "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE NULL END",
    "RatecodeID": "NULLIF(l_linenumber, 7)",
    "payment_type": "CAST(SUBSTRING(o_orderpriority, 1, 1) AS INT) - 1",
    "store_and_fwd_flag": "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE NULL END",
    "tolls_amount": "CASE WHEN l_tax > 0.06e0 THEN 6.55e0 WHEN l_tax > 0.05e0 THEN -1e0 ELSE NULL END",
    "Airport_fee": "CASE WHEN l_suppkey % 10 = 0 THEN 1.75e0 ELSE NULL END",
    "congestion_surcharge": "CASE WHEN l_linenumber % 2 = 0 THEN 2.5e0 ELSE NULL END",
}

# Stage records: the event stream read as runs of pipeline stages.
STAGE_RUN_COLUMNS = {
    "stage": "event_type",
    "pipeline_run_id": "CAST(user_id AS VARCHAR(20))",
    "run_id": "CAST(event_id AS VARCHAR(20))",
    "created_at": "ts",
    "status": "CASE WHEN value < 2e0 THEN 'failed' WHEN value < 4e0 THEN 'skipped' ELSE 'success' END",
    "rows_processed": "event_id % 5000",
    "duration_seconds": "value",
}

# Three stand-in models: a prediction per trip, computed from its own columns.
MODEL_COLUMNS = {
    "by_distance": "60e0 + trip_distance / 7e0",
    "by_fare": "40e0 + fare_amount / 7e0",
    "constant": "630.5e0 / 7e0",
}


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spread(table(spark, sf_dir, "lineitem")), table(spark, sf_dir, "orders")


def trips(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    columns = _aliased(TRIP_COLUMNS) + (TRIP_KEY if with_key else [])
    return _order_lines(*_tables(spark, sf_dir)).selectExpr(*columns)


def prediction_log_from(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_aliased(PREDICTION_LOG_COLUMNS))


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_log_from(table(spark, sf_dir, "events"))


def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_aliased(STAGE_RUN_COLUMNS))


def request_json_from(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Requests as JSON text in ``value``, beside the trip key; absent fields are left out."""
    fields = ", ".join(f"'{name}', {expr}" for name, expr in REQUEST_COLUMNS.items())
    return _order_lines(lines, orders).selectExpr(*TRIP_KEY, f"to_json(named_struct({fields})) AS value")


def request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_json_from(*_tables(spark, sf_dir))
