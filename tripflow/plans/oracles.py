"""SQL that states each named query for another engine, on the same tables."""

from __future__ import annotations

from tripflow import fixtures, schema
from tripflow.plans import queries as q
from tripflow.streaming import monitor

KEY = ", ".join(fixtures.TRIP_KEY)


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


def r(expr: str, places: int = 6) -> str:
    """Fewer places; adding zero turns a negative zero into zero."""
    return f"(ROUND({expr}, {places}) + 0e0)"


ORDER_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
TRIPS = f"SELECT {_select(fixtures.TRIP_COLUMNS)}, {KEY} FROM {ORDER_LINES}"
DURATION = "date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60e0"
DURATED = f"SELECT *, {DURATION} AS trip_duration_min FROM trips"

SILVER_EXPR = {c: c for c in schema.SILVER_COLUMNS}
SILVER_EXPR |= {
    "passenger_count": "COALESCE(passenger_count, 1)",
    "RatecodeID": "LEAST(GREATEST(COALESCE(RatecodeID, 1), 1), 6)",
    "store_and_fwd_flag": "COALESCE(store_and_fwd_flag, 'N')",
    "congestion_surcharge": "COALESCE(congestion_surcharge, 0e0)",
    "Airport_fee": "COALESCE(Airport_fee, 0e0)",
    "tip_amount": "CASE WHEN tip_amount < 0 THEN 0e0 WHEN tip_amount > 2e0 * fare_amount THEN 2e0 * fare_amount"
    " ELSE tip_amount END",
}
VALID = (
    "trip_duration_min > 0 AND trip_duration_min < 180 AND trip_distance > 0 AND trip_distance < 60"
    " AND total_amount >= 0 AND fare_amount > 0 AND fare_amount < 500"
)
SILVER = f"SELECT {_select(SILVER_EXPR)}, {KEY} FROM durated WHERE {VALID}"

P = "tpep_pickup_datetime"


def time_parts(ts: str) -> dict[str, str]:
    return {
        "pickup_hour": f"CAST(hour({ts}) AS INTEGER)",
        "pickup_day_of_month": f"CAST(day({ts}) AS INTEGER)",
        "pickup_week_of_year": f"CAST(weekofyear({ts}) AS INTEGER)",
        "pickup_month": f"CAST(month({ts}) AS INTEGER)",
        "pickup_year": f"CAST(year({ts}) AS INTEGER)",
        "pickup_day_of_week": f"CAST(isodow({ts}) - 1 AS INTEGER)",
    }


def time_flags(ts: str) -> dict[str, str]:
    peak = f"(hour({ts}) BETWEEN 7 AND 10 OR hour({ts}) BETWEEN 16 AND 19)"
    return {
        "is_weekend": f"isodow({ts}) >= 6",
        "is_peak_hour": peak,
        "is_night": f"(hour({ts}) >= 22 OR hour({ts}) <= 5)",
        "is_rush_hour": peak,
    }


def cyclical(ts: str) -> dict[str, str]:
    hour, day = f"2 * pi() * hour({ts}) / 24", f"2 * pi() * (isodow({ts}) - 1) / 7"
    return {
        "sin_hour": r(f"sin({hour})"),
        "cos_hour": r(f"cos({hour})"),
        "sin_day_of_week": r(f"sin({day})"),
        "cos_day_of_week": r(f"cos({day})"),
    }


DISTANCE = {
    "is_short_trip": "trip_distance < 1",
    "is_long_trip": "trip_distance > 10",
    "log_trip_distance": "ln(1 + trip_distance)",
    "sqrt_trip_distance": "sqrt(trip_distance)",
}
ROUTE = {
    "route_id": "concat_ws('_', CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR))",
    "is_same_zone": "PULocationID = DOLocationID",
}
SURCHARGES = (
    "COALESCE(extra, 0e0) + COALESCE(congestion_surcharge, 0e0) + COALESCE(Airport_fee, 0e0)"
    " + COALESCE(cbd_congestion_fee, 0e0)"
)
RATIOS = {
    "fare_per_mile": "CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END",
    "surcharge_ratio": f"CASE WHEN total_amount <> 0 THEN ({SURCHARGES}) / total_amount END",
    "toll_ratio": "CASE WHEN total_amount <> 0 THEN tolls_amount / total_amount END",
}
FEES = {
    "has_tolls": "CAST(COALESCE(tolls_amount, 0) > 0 AS INTEGER)",
    "has_airport_fee": "CAST(COALESCE(Airport_fee, 0) > 0 AS INTEGER)",
    "has_congestion_fee": "CAST(COALESCE(congestion_surcharge, 0) > 0 AS INTEGER)",
}
MONEY = {**FEES, "non_fare_amount": "total_amount - fare_amount"}

# Gold without rounding, so that it can feed the model table.
RAW_CYCLICAL = {k: v[len("(ROUND(") : -len(", 6) + 0e0)")] for k, v in cyclical(P).items()}
GOLD_BASE_EXPR = {**time_parts(P), **time_flags(P), **RAW_CYCLICAL, **DISTANCE, **ROUTE, **RATIOS, **MONEY}
GOLD_BASE = (
    f"SELECT silver.* REPLACE (CAST(PULocationID AS INTEGER) AS PULocationID, CAST(DOLocationID AS INTEGER) AS DOLocationID),"
    f" {_select(GOLD_BASE_EXPR)} FROM silver"
)


def _count(keys: str, name: str) -> str:
    return f"SELECT pickup_year, pickup_month, {keys}, COUNT(*) AS {name} FROM gold_base GROUP BY ALL"


def _count_join(alias: str, key: str) -> str:
    return (
        f" LEFT JOIN {alias} ON g.pickup_year = {alias}.pickup_year AND g.pickup_month = {alias}.pickup_month"
        f" AND g.{key} = {alias}.{key}"
    )


GOLD = (
    "SELECT g.* EXCLUDE (tpep_dropoff_datetime, total_amount), pickup_zone_trip_count, dropoff_zone_trip_count,"
    " route_trip_count FROM gold_base g"
    + _count_join("pu", "PULocationID") + _count_join("dropoff", "DOLocationID") + _count_join("route", "route_id")
)

SECONDS = f"date_diff('second', TIMESTAMP '1970-01-01', {P})"


def _split(source: str) -> str:
    return (
        f"SELECT s.*, CASE WHEN {SECONDS} <= train_until THEN 'train' WHEN {SECONDS} <= test_until THEN 'test'"
        f" ELSE 'val' END AS split FROM {source} s CROSS JOIN (SELECT quantile_disc({SECONDS}, 0.70) AS train_until,"
        f" quantile_disc({SECONDS}, 0.85) AS test_until FROM {source})"
    )


TABLES = {
    "trips": TRIPS,
    "durated": DURATED,
    "silver": SILVER,
    "gold_base": GOLD_BASE,
    "pu": _count("PULocationID", "pickup_zone_trip_count"),
    "dropoff": _count("DOLocationID", "dropoff_zone_trip_count"),
    "route": _count("route_id", "route_trip_count"),
    "gold": GOLD,
    "silver_split": _split("silver"),
    "gold_split": _split("gold"),
}
NEEDS = {
    "trips": [],
    "durated": ["trips"],
    "silver": ["trips", "durated"],
    "gold_base": ["trips", "durated", "silver"],
    "gold": ["trips", "durated", "silver", "gold_base", "pu", "dropoff", "route"],
    "silver_split": ["trips", "durated", "silver"],
    "gold_split": ["trips", "durated", "silver", "gold_base", "pu", "dropoff", "route", "gold"],
}


def over(table: str, body: str, **more: str) -> str:
    """``body`` after the common tables up to ``table`` and any more, all in one WITH."""
    parts = {name: TABLES[name] for name in [*NEEDS[table], table]} | more
    return "WITH " + ", ".join(f"{name} AS ({text})" for name, text in parts.items()) + " " + body


ORACLES: dict[str, str] = {}

# --- flagship, scans, sinks ----------------------------------------------------------------

ORACLES["zone_hour_summary"] = over(
    "silver",
    f"SELECT CAST(PULocationID AS INTEGER) AS PULocationID, CAST(hour({P}) AS INTEGER) AS pickup_hour,"
    f" COUNT(*) AS trips, {r('AVG(trip_duration_min)', 8)} AS mean_duration_min FROM silver GROUP BY 1, 2",
)
ORACLES["scan_trips"] = f"SELECT {_select(fixtures.TRIP_COLUMNS)} FROM {ORDER_LINES}"
MONTH = f"CAST(year({P}) AS INTEGER) AS year, CAST(month({P}) AS INTEGER) AS month"
ORACLES["land_months"] = over("trips", f"SELECT {MONTH}, COUNT(*) AS rows, 'success' AS status FROM trips GROUP BY 1, 2")
ORACLES["pending_partitions"] = over(
    "trips", f"SELECT {MONTH}, COUNT(*) AS rows FROM trips WHERE year({P}) > {q.COMMITTED_UNTIL} GROUP BY 1, 2"
)
ORACLES["refresh_layer"] = over(
    "durated",
    f"SELECT {MONTH}, COUNT(*) AS bronze_rows, 'committed' AS status,"
    f" COUNT(*) FILTER (WHERE {VALID}) AS silver_rows FROM durated GROUP BY 1, 2",
)
# What three refreshes leave: halved distances, a year gone, and another emptied and back.
_changed = (
    f"SELECT * REPLACE (CASE WHEN year({P}) = {q.REPLACED_YEAR} THEN trip_distance / 2e0 ELSE trip_distance END AS trip_distance)"
    f" FROM trips WHERE year({P}) <> {q.GONE_YEAR}"
)
ORACLES["refresh_replaced"] = over(
    "trips",
    f"SELECT {', '.join(schema.SILVER_COLUMNS)}, {KEY}, {MONTH}, CASE year({P}) WHEN {q.REPLACED_YEAR} THEN 2"
    f" WHEN {q.EMPTIED_YEAR} THEN 3 ELSE 1 END AS version FROM silver",
    changed=_changed,
    durated=DURATED.replace("FROM trips", "FROM changed"),
    silver=SILVER,
)
_months = f"COUNT(DISTINCT year({P}) * 100 + month({P}))"
ORACLES["stage_records"] = over(
    "silver",
    f"SELECT 'land_months' AS stage, 'success' AS status, COUNT(*) AS rows_read, COUNT(*) AS rows_written, {_months} AS parts,"
    " CAST(NULL AS VARCHAR) AS error FROM trips"
    f" UNION ALL SELECT 'refresh_layer', 'success', (SELECT COUNT(*) FROM trips), COUNT(*), (SELECT {_months} FROM trips), NULL"
    " FROM silver UNION ALL SELECT 'validation', 'failed', 14, NULL, 14, 'ValueError'",
)
ORACLES["write_layer"] = over(
    "silver",
    f"SELECT {MONTH}, COUNT(*) AS rows, {r('SUM(fare_amount)')} AS fares, {r('MAX(tip_amount)')} AS highest_tip"
    " FROM silver GROUP BY 1, 2",
)
ORACLES["cap_rows"] = over("trips", f"SELECT {KEY}, {P}, trip_distance FROM trips ORDER BY {P}, {KEY} LIMIT {q.CAP}")


def _fraction(seed: int) -> str:
    text = "concat_ws('|', " + ", ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in fixtures.TRIP_KEY]]) + ")"
    return f"CAST(('0x' || substring(md5({text}), 1, 8)) AS BIGINT) / 4294967296e0"


ORACLES["sample_rows"] = over(
    "trips", f"SELECT {KEY}, trip_distance, fare_amount FROM trips WHERE {_fraction(q.SEED)} < {q.SAMPLE_FRACTION}"
)
ORACLES["feature_target_view"] = over(
    "silver", "SELECT trip_distance, passenger_count, PULocationID, DOLocationID, trip_duration_min FROM silver"
)

# --- validation ----------------------------------------------------------------------------

_absent = [
    f"CASE WHEN MAX(CASE WHEN column_name = '{c}' THEN 1 ELSE 0 END) = 0 THEN '{c}' END" for c in q.REQUIRED_EXAMPLE
]
ORACLES["validate_columns"] = (
    "SELECT file_name, missing, CASE WHEN missing = '' THEN 'success' ELSE 'failed' END AS status FROM ("
    f"SELECT table_name || '.parquet' AS file_name, concat_ws(',', {', '.join(_absent)}) AS missing"
    " FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders',"
    " 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')"
    " GROUP BY table_name)"
)
ORACLES["validate_counts"] = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file_name, COUNT(*) AS rows, COUNT(*) <= 2000000 AS within_budget FROM {t}"
    for t in fixtures.TABLES
)
BROKEN = {
    "duration": "NOT COALESCE(trip_duration_min > 0 AND trip_duration_min < 180, FALSE)",
    "distance": "NOT COALESCE(trip_distance > 0 AND trip_distance < 60, FALSE)",
    "fare": "NOT COALESCE(fare_amount > 0 AND fare_amount < 500, FALSE)",
    "total": "NOT COALESCE(total_amount >= 0, FALSE)",
}
ORACLES["rule_violations"] = over(
    "durated",
    " UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {broken}) AS violations, COUNT(*) AS rows FROM durated"
        for name, broken in BROKEN.items()
    ),
)
_rule_names = ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in BROKEN.items())
ORACLES["quarantine_trips"] = over(
    "durated",
    f"SELECT {KEY}, concat_ws(',', {_rule_names}) AS broken_rules FROM durated WHERE {' OR '.join(BROKEN.values())}",
)

# --- silver and gold -----------------------------------------------------------------------

ORACLES["trip_duration"] = over("durated", f"SELECT {KEY}, trip_duration_min FROM durated")
ORACLES["silver_trips"] = over("silver", f"SELECT {', '.join(schema.SILVER_COLUMNS)} FROM silver")
ORACLES["impute_defaults"] = over(
    "trips",
    f"SELECT {KEY}, COALESCE(passenger_count, 1) AS passenger_count, COALESCE(RatecodeID, 1) AS RatecodeID,"
    " COALESCE(congestion_surcharge, 0e0) AS congestion_surcharge, COALESCE(Airport_fee, 0e0) AS Airport_fee,"
    " COALESCE(store_and_fwd_flag, 'N') AS store_and_fwd_flag FROM trips",
)
ORACLES["clamp_rate_code"] = over(
    "trips",
    f"SELECT {KEY}, CASE WHEN RatecodeID IS NULL THEN NULL ELSE LEAST(GREATEST(RatecodeID, 1), 6) END AS RatecodeID FROM trips",
)
ORACLES["cap_tip"] = over("trips", f"SELECT {KEY}, fare_amount, {SILVER_EXPR['tip_amount']} AS tip_amount FROM trips")
ORACLES["time_parts"] = over("trips", f"SELECT {KEY}, {_select(time_parts(P))} FROM trips")
ORACLES["time_flags"] = over("trips", f"SELECT {KEY}, {_select(time_flags(P))} FROM trips")
ORACLES["cyclical_time"] = over("trips", f"SELECT {KEY}, {_select(cyclical(P))} FROM trips")
_rounded_distance = {k: (r(v) if k.startswith(("log", "sqrt")) else v) for k, v in DISTANCE.items()}
ORACLES["distance_features"] = over("trips", f"SELECT {KEY}, {_select(_rounded_distance)} FROM trips")
ORACLES["route_features"] = over(
    "trips",
    f"SELECT {KEY}, CAST(PULocationID AS INTEGER) AS PULocationID, CAST(DOLocationID AS INTEGER) AS DOLocationID,"
    f" {_select(ROUTE)} FROM trips",
)
ORACLES["fare_ratios"] = over("trips", f"SELECT {KEY}, {_select(RATIOS)} FROM trips")
ORACLES["fee_flags"] = over("trips", f"SELECT {KEY}, {_select(MONEY)} FROM trips")
ORACLES["zone_trip_counts"] = over("gold_base", TABLES["pu"])
ORACLES["dropoff_trip_counts"] = over("gold_base", TABLES["dropoff"])
ORACLES["route_trip_counts"] = over("gold_base", TABLES["route"])
_gold_rounding = ", ".join(f"{r(c)} AS {c}" for c in q.TRANSCENDENTAL)
ORACLES["gold_trips"] = over("gold", f"SELECT * EXCLUDE ({KEY}) REPLACE ({_gold_rounding}) FROM gold")

# --- encode, scale, split ------------------------------------------------------------------

ORACLES["category_levels"] = over(
    "silver",
    " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS INTEGER) AS level FROM silver WHERE {c} IS NOT NULL"
        for c in schema.ONEHOT_COLUMNS
    ),
)


def _means(source: str) -> str:
    train = f"FROM {source} WHERE split = 'train'"
    parts = [
        f"SELECT '{c}' AS \"column\", CAST({c} AS BIGINT) AS category, AVG(trip_duration_min) AS mean_target"
        f" {train} AND {c} IS NOT NULL GROUP BY {c}"
        for c in schema.TARGET_ENCODED_COLUMNS
    ]
    parts.append(f"SELECT NULL AS \"column\", NULL AS category, AVG(trip_duration_min) AS mean_target {train}")
    return " UNION ALL ".join(parts)


ORACLES["target_means"] = over(
    "silver_split", f'SELECT "column", category, {r("mean_target")} AS mean_target FROM means', means=_means("silver_split")
)


def _scaling(source: str, where: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", AVG({c}) AS mean,"
        f" CASE WHEN STDDEV_SAMP({c}) > 0 THEN STDDEV_SAMP({c}) ELSE 1e0 END AS stddev FROM {source} WHERE {where}"
        for c in columns
    )


ORACLES["scaling_stats"] = over(
    "gold",
    f'SELECT "column", {r("mean")} AS mean, {r("stddev")} AS stddev FROM ({_scaling("gold", "TRUE", schema.SCALED_COLUMNS)})',
)
ORACLES["split_thresholds"] = over(
    "trips",
    f"SELECT quantile_disc({SECONDS}, 0.70) AS train_until, quantile_disc({SECONDS}, 0.85) AS test_until FROM trips",
)
ORACLES["time_split"] = over("silver_split", f"SELECT {KEY}, {P}, split FROM silver_split")
ORACLES["random_split"] = over(
    "trips", f"SELECT {KEY}, CASE WHEN {_fraction(q.SEED)} < {q.TRAIN_SHARE} THEN 'train' ELSE 'test' END AS split FROM trips"
)
ORACLES["union_splits"] = over(
    "silver_split", f"SELECT {KEY}, trip_distance, trip_duration_min, split FROM silver_split WHERE split IN ('train', 'val')"
)
_kept = [c for c in schema.SILVER_COLUMNS if c not in [*schema.LEAKAGE_COLUMNS, *schema.NON_PREDICTIVE_COLUMNS, schema.DROPOFF]]
ORACLES["drop_leakage"] = over("silver", f"SELECT {', '.join(_kept)} FROM silver")
FLAG = "CASE WHEN store_and_fwd_flag = 'Y' THEN 1 ELSE 0 END"
ORACLES["encode_binary"] = over("trips", f"SELECT {KEY}, {FLAG} AS store_and_fwd_flag FROM trips")
ONEHOT = {
    name: f"CASE WHEN {name.rsplit('_', 1)[0]} = {name.rsplit('_', 1)[1]} THEN 1 ELSE 0 END"
    for name in schema.FEATURES
    if name.rsplit("_", 1)[0] in schema.ONEHOT_COLUMNS
}
ORACLES["encode_onehot"] = over("silver", f"SELECT {KEY}, {_select(ONEHOT)} FROM silver")


def _encoded(column: str) -> str:
    return f"COALESCE({column}_m.mean_target, overall.mean_target)"


MEANS_JOIN = "".join(
    f" LEFT JOIN means {c}_m ON {c}_m.\"column\" = '{c}' AND {c}_m.category = s.{c}" for c in schema.TARGET_ENCODED_COLUMNS
) + ' CROSS JOIN (SELECT mean_target FROM means WHERE "column" IS NULL) overall'
_encodings = {f"{c}_encoded": r(_encoded(c)) for c in schema.TARGET_ENCODED_COLUMNS}
ORACLES["encode_target"] = over(
    "silver_split", f"SELECT {KEY}, {_select(_encodings)} FROM silver_split s {MEANS_JOIN}", means=_means("silver_split")
)


def _stats(columns: list[str], source: str) -> str:
    return "SELECT " + ", ".join(
        f"AVG({c}) AS {c}_mean, CASE WHEN STDDEV_SAMP({c}) > 0 THEN STDDEV_SAMP({c}) ELSE 1e0 END AS {c}_std" for c in columns
    ) + f" FROM {source} WHERE split = 'train'"


ORACLES["scale_features"] = over(
    "gold_split",
    f"SELECT {KEY}, " + ", ".join(f"{r(f'({c} - {c}_mean) / {c}_std')} AS {c}" for c in schema.SCALED_COLUMNS)
    + " FROM gold_split CROSS JOIN stats",
    stats=_stats(schema.SCALED_COLUMNS, "gold_split"),
)

FEATURE_EXPR: dict[str, str] = {}
for _name in schema.FEATURES:
    if _name == "store_and_fwd_flag":
        FEATURE_EXPR[_name] = FLAG
    elif _name in ONEHOT:
        FEATURE_EXPR[_name] = ONEHOT[_name]
    elif _name.endswith("_encoded"):
        FEATURE_EXPR[_name] = _encoded(_name.removesuffix("_encoded"))
    elif _name in schema.SCALED_COLUMNS:
        FEATURE_EXPR[_name] = f"(s.{_name} - {_name}_mean) / {_name}_std"
    else:
        FEATURE_EXPR[_name] = f"s.{_name}"
_DOUBLES = [*schema.SCALED_COLUMNS, "sin_hour", "cos_hour", "sin_day_of_week", "cos_day_of_week"]
_ml_select = ", ".join(
    f"{r(e) if n in _DOUBLES or n.endswith('_encoded') else e} AS {n}" for n, e in FEATURE_EXPR.items()
)
ML = {"means": _means("gold_split"), "stats": _stats(schema.SCALED_COLUMNS, "gold_split")}
ML_FROM = f"FROM gold_split s {MEANS_JOIN} CROSS JOIN stats"
ORACLES["ml_table"] = over(
    "gold_split", f"SELECT {_ml_select}, {r('s.trip_duration_min')} AS trip_duration_min, s.split {ML_FROM}", **ML
)
_levels = " UNION ALL ".join(
    f"SELECT 'level' AS kind, '{n.rsplit('_', 1)[0]}' AS \"column\", '{n.rsplit('_', 1)[1]}' AS key,"
    f" {n.rsplit('_', 1)[1]}e0 AS value"
    for n in ONEHOT
)
ORACLES["fitted_state"] = over(
    "gold_split",
    f'{_levels} UNION ALL SELECT \'mean\' AS kind, "column", NULL AS key, {r("mean")} AS value FROM scaling'
    f' UNION ALL SELECT \'stddev\' AS kind, "column", NULL AS key, {r("stddev")} AS value FROM scaling'
    f' UNION ALL SELECT \'target_mean\' AS kind, "column", CAST(category AS VARCHAR) AS key, {r("mean_target")} AS value FROM means'
    + "".join(f" UNION ALL SELECT 'onehot', '{c}', NULL, NULL" for c in schema.ONEHOT_COLUMNS)
    + "".join(f" UNION ALL SELECT 'target', '{c}', '{i}', NULL" for i, c in enumerate(schema.TARGET_ENCODED_COLUMNS)),
    means=_means("gold_split"),
    scaling=_scaling("gold_split", "split = 'train'", schema.SCALED_COLUMNS),
)
_BOOLEANS = ["is_weekend", "is_peak_hour", "is_night", "is_rush_hour", "is_short_trip", "is_long_trip", "is_same_zone"]
_sum = " + ".join(f"CAST({e} AS INTEGER)" if n in _BOOLEANS else f"({e})" for n, e in FEATURE_EXPR.items())
ORACLES["assemble_features"] = over(
    "gold_split",
    f"SELECT {r('s.trip_duration_min')} AS label, 41 AS n_features, {r(_sum)} AS feature_sum {ML_FROM}", **ML
)

# --- profiles and run records --------------------------------------------------------------

_types = {
    "int": ["VendorID", "RatecodeID", "payment_type"],
    "timestamp_ntz": ["tpep_pickup_datetime", "tpep_dropoff_datetime"],
    "bigint": ["passenger_count", "PULocationID", "DOLocationID"],
    "string": ["store_and_fwd_flag"],
}
_type_of = {c: t for t, columns in _types.items() for c in columns}
# Filled with defaults, or constants of the view over the tables.
_never_null = [*schema.NULL_DEFAULTS, "mta_tax", "improvement_surcharge", "VendorID", "tolls_amount", "cbd_congestion_fee"]
ORACLES["profile_table"] = over(
    "silver",
    "SELECT row_count, 21 AS column_count, position, name, type, nullable"
    " FROM (SELECT COUNT(*) AS row_count FROM silver), (VALUES "
    + ", ".join(
        f"({i}, '{c}', '{_type_of.get(c, 'double')}', {c not in _never_null})" for i, c in enumerate(schema.SILVER_COLUMNS)
    )
    + ") AS t(position, name, type, nullable)",
)


def _profile(source: str, column: str, keys: str = "") -> str:
    numeric = _type_of.get(column) not in ("timestamp_ntz", "string")
    ends = {name: f"CAST({name}({column}) AS DOUBLE)" for name in ("min", "max")}
    # Ends by month are compared as they are: halves of the last place, which engines round apart, occur among them.
    stats = {
        **(ends if keys else {name: r(end) for name, end in ends.items()}),
        "mean": r(f"AVG({column})"),
        "stddev": r(f"STDDEV_SAMP({column})"),
    }
    listed = _select(stats if numeric else dict.fromkeys(stats, "CAST(NULL AS DOUBLE)"))
    lead = f"{MONTH}, " if keys else ""
    return (
        f"SELECT {lead}'{column}' AS \"column\", COUNT(*) AS rows, COUNT(*) - COUNT({column}) AS nulls,"
        f" CAST(0 AS BIGINT) AS nans, {listed} FROM {source}{keys}"
    )


ORACLES["profile_columns"] = over("trips", " UNION ALL ".join(_profile("trips", c) for c in fixtures.TRIP_COLUMNS))
ORACLES["profile_by_month"] = over(
    "silver",
    " UNION ALL ".join(
        _profile("silver", c, " GROUP BY 1, 2") for c in schema.SILVER_COLUMNS
    ),
)
RUNS = f"SELECT {_select(fixtures.STAGE_RUN_COLUMNS)} FROM events"
ORACLES["latest_stage_run"] = (
    f"SELECT * EXCLUDE (n) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY stage ORDER BY created_at DESC, run_id DESC) AS n"
    f" FROM ({RUNS})) WHERE n = 1"
)
ORACLES["run_rollup"] = (
    "SELECT stage, pipeline_run_id, COUNT(*) AS inputs, COUNT(*) FILTER (WHERE status = 'success') AS processed,"
    " COUNT(*) FILTER (WHERE status = 'skipped') AS skipped, COUNT(*) FILTER (WHERE status = 'failed') AS failed,"
    " CAST(SUM(rows_processed) FILTER (WHERE status = 'success') AS BIGINT) AS rows_processed,"
    f" {r('SUM(duration_seconds)')} AS duration_seconds,"
    " CASE WHEN COUNT(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed' ELSE 'success' END AS run_status"
    f" FROM ({RUNS}) GROUP BY 1, 2"
)

# --- metrics, gates, comparison ------------------------------------------------------------

PREDICTIONS = " UNION ALL ".join(
    f"SELECT '{m}' AS model, trip_duration_min AS actual, {e} AS predicted, payment_type, PULocationID AS zone FROM silver"
    for m, e in fixtures.MODEL_COLUMNS.items()
)


def _metrics(keys: str, where: str = "TRUE") -> str:
    lead = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    sst = "SUM((actual - m) * (actual - m))"
    over_keys = f"PARTITION BY {keys}" if keys else ""
    return (
        f"SELECT {lead}COUNT(*) AS rows, SQRT(AVG((actual - predicted) * (actual - predicted))) AS rmse,"
        f" AVG(ABS(actual - predicted)) AS mae, CASE WHEN {sst} > 0 THEN 1 - SUM((actual - predicted) * (actual - predicted)) / {sst}"
        f" WHEN SUM(ABS(actual - predicted)) = 0 THEN 1e0 ELSE 0e0 END AS r2 FROM"
        f" (SELECT *, AVG(actual) OVER ({over_keys}) AS m FROM predictions WHERE {where}){group}"
    )


_r3 = f"{r('rmse')} AS rmse, {r('mae')} AS mae, {r('r2')} AS r2"
ORACLES["regression_metrics"] = over(
    "silver", f"SELECT model, rows, {_r3} FROM ({_metrics('model')})", predictions=PREDICTIONS
)
ORACLES["metrics_by_segment"] = over(
    "silver", f"SELECT model, payment_type, rows, {_r3} FROM ({_metrics('model, payment_type')})", predictions=PREDICTIONS
)
_by_distance = "model = 'by_distance'"
ORACLES["evaluator_metrics"] = over(
    "silver", f"SELECT {_r3} FROM ({_metrics('', _by_distance)})", predictions=PREDICTIONS
)
ORACLES["leaderboard_topn"] = over(
    "silver",
    f"SELECT model, payment_type, rows, {_r3}, rank FROM (SELECT *, CAST(ROW_NUMBER() OVER"
    f" (PARTITION BY payment_type ORDER BY rmse, model) AS INTEGER) AS rank FROM ({_metrics('model, payment_type')}))"
    " WHERE rank <= 2",
    predictions=PREDICTIONS,
)
_new = _metrics("zone", "model = 'by_distance'")
_old = _metrics("zone", _by_distance.replace("by_distance", "by_fare"))
_broken_gate = {
    f"r2 < {q.GATE['min_r2']}": f"printf('R2 %.4f < min_r2 threshold {q.GATE['min_r2']}', r2)",
    f"rmse > {q.GATE['max_rmse']}": f"printf('RMSE %.4f > max_rmse threshold {q.GATE['max_rmse']}', rmse)",
    f"mae > {q.GATE['max_mae']}": f"printf('MAE %.4f > max_mae threshold {q.GATE['max_mae']}', mae)",
}
_gate_passed = " AND ".join(f"NOT ({c})" for c in _broken_gate)
ORACLES["quality_gate"] = over(
    "silver",
    f"SELECT zone, rows, {_r3}, concat_ws('; ', "
    + ", ".join(f"CASE WHEN {c} THEN {m} END" for c, m in _broken_gate.items())
    + f") AS violations, {_gate_passed} AS passed, "
    + ", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in q.GATE.items())
    + f" FROM ({_new})",
    predictions=PREDICTIONS,
)
COMPARED = (
    "SELECT n.zone, n.rmse AS new_rmse, n.mae AS new_mae, n.r2 AS new_r2, o.rmse AS old_rmse, o.mae AS old_mae, o.r2 AS old_r2,"
    " o.rmse - n.rmse AS rmse_delta, o.mae - n.mae AS mae_delta, n.r2 - o.r2 AS r2_delta,"
    " COALESCE(o.rmse - n.rmse >= 0, TRUE) AS rmse_improved, COALESCE(o.mae - n.mae >= 0, TRUE) AS mae_improved,"
    f" COALESCE(n.r2 - o.r2 >= 0, TRUE) AS r2_improved FROM ({_new}) n LEFT JOIN ({_old}) o ON n.zone = o.zone"
)
DECIDED = (
    "SELECT *, rmse_improved AND mae_improved AND r2_improved AS is_new_better, CASE WHEN old_rmse IS NULL THEN 'no_production_model'"
    " WHEN rmse_improved AND mae_improved AND r2_improved THEN 'meets_rmse_improvement_and_no_material_mae_r2_regression'"
    " ELSE 'fails_promotion_policy_thresholds' END AS decision_reason FROM compared"
)
_deltas = [f"{side}_{m}" for side in ("new", "old") for m in ("rmse", "mae", "r2")] + ["rmse_delta", "mae_delta", "r2_delta"]
ORACLES["compare_models"] = over(
    "silver",
    f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in _deltas)}) FROM decided",
    predictions=PREDICTIONS, compared=COMPARED, decided=DECIDED,
)
ORACLES["promotion_decision"] = over(
    "silver",
    "SELECT zone, is_new_better, decision_reason, quality_gate_passed, is_new_better AND quality_gate_passed AS should_promote"
    f" FROM decided JOIN (SELECT zone, {_gate_passed} AS quality_gate_passed FROM ({_new})) USING (zone)",
    predictions=PREDICTIONS, compared=COMPARED, decided=DECIDED,
)
ORACLES["feature_contract"] = over(
    "silver_split",
    "SELECT trip_distance, passenger_count, PULocationID, trip_duration_min, split FROM silver_split WHERE split IN ('train', 'val')",
)

# --- drift ---------------------------------------------------------------------------------


def _unpivoted(columns: list[str], kind: str) -> str:
    value = "CAST({} AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS category" if kind == "number" else (
        "CAST(NULL AS DOUBLE) AS number, CAST({} AS VARCHAR) AS category"
    )
    return " UNION ALL ".join(
        f"SELECT '{c}' AS c, {value.format(c)}, CASE WHEN year({P}) <= {q.REFERENCE_UNTIL} THEN 1 ELSE 0 END AS is_ref"
        f" FROM silver WHERE {c} IS NOT NULL"
        for c in columns
    )


FREQ = "SELECT c, number, category, SUM(is_ref) AS n_ref, SUM(1 - is_ref) AS n_cur FROM sides GROUP BY 1, 2, 3"
DRIFT = {
    "freq": FREQ,
    "totals": "SELECT c, CAST(SUM(n_ref) AS BIGINT) AS ref_rows, CAST(SUM(n_cur) AS BIGINT) AS cur_rows, COUNT(*) AS n_values,"
    " MAX(CASE WHEN number IS NULL THEN 0 ELSE 1 END) = 1 AS is_numeric, SUM(n_ref * number) / SUM(n_ref) AS ref_mean"
    " FROM freq GROUP BY c",
    "cdf": "SELECT c, number, n_ref, ref_mean, ref_rows, cur_rows,"
    " ABS(SUM(n_ref) OVER w * 1e0 / ref_rows - SUM(n_cur) OVER w * 1e0 / cur_rows) AS gap,"
    " LEAD(number) OVER (PARTITION BY c ORDER BY number) AS next_number FROM freq JOIN totals USING (c)"
    " WHERE number IS NOT NULL"
    " WINDOW w AS (PARTITION BY c ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    "ordered": "SELECT c, MAX(gap) AS ks, COALESCE(SUM(gap * (next_number - number)), 0) AS w1,"
    " SQRT(SUM(n_ref * (number - ref_mean) * (number - ref_mean)) / SUM(n_ref)) AS sd, MIN(ref_rows) AS nr, MIN(cur_rows) AS nc"
    " FROM cdf GROUP BY c",
    "shares": "SELECT c, n_ref, n_cur, ref_rows, cur_rows, n_values, is_numeric, n_ref * 1e0 / ref_rows AS p,"
    " n_cur * 1e0 / cur_rows AS q, (n_ref * 1e0 / ref_rows + n_cur * 1e0 / cur_rows) / 2 AS m,"
    " ROW_NUMBER() OVER (PARTITION BY c ORDER BY number DESC, category DESC) AS from_top FROM freq JOIN totals USING (c)",
    "compared": "SELECT c, ref_rows, cur_rows, n_values, is_numeric, SQRT(GREATEST(SUM((CASE WHEN p > 0 THEN p * LN(p / m) ELSE 0 END)"
    " + (CASE WHEN q > 0 THEN q * LN(q / m) ELSE 0 END)) / 2, 0)) AS js,"
    " SUM(CASE WHEN p > 0 THEN (n_cur - p * cur_rows) * (n_cur - p * cur_rows) / (p * cur_rows) ELSE 0 END) AS chi2,"
    " SUM(CASE WHEN p > 0 THEN 0 ELSE q END) AS new_share,"
    " CASE WHEN n_values = 2 THEN MAX(CASE WHEN from_top = 1 THEN (p - q) / SQRT((n_ref + n_cur) * 1e0 / (ref_rows + cur_rows)"
    " * (1 - (n_ref + n_cur) * 1e0 / (ref_rows + cur_rows)) * (1e0 / ref_rows + 1e0 / cur_rows)) END) END AS z"
    " FROM shares GROUP BY c, ref_rows, cur_rows, n_values, is_numeric",
    "detected": "SELECT compared.c AS c, is_numeric, ref_rows, cur_rows, n_values, new_share,"
    " CASE WHEN is_numeric AND n_values > 5 THEN 'wasserstein' ELSE 'js' END AS method,"
    " CASE WHEN is_numeric AND n_values > 5 THEN w1 / GREATEST(sd, 0.001) ELSE js END AS score"
    " FROM compared LEFT JOIN ordered ON compared.c = ordered.c",
}


def _drift(body: str, numeric: list[str], categorical: list[str], needed: list[str]) -> str:
    sides = " UNION ALL ".join(
        part for part in (_unpivoted(numeric, "number") if numeric else "", _unpivoted(categorical, "text") if categorical else "") if part
    )
    return over("silver", body, sides=sides, **{n: DRIFT[n] for n in needed})


_ORDERED, _SHARES = ["freq", "totals", "cdf", "ordered"], ["freq", "totals", "shares", "compared"]
_ALL = ["freq", "totals", "cdf", "ordered", "shares", "compared", "detected"]
ORACLES["drift_ks"] = _drift(
    f"SELECT c AS \"column\", {r('MAX(ks)')} AS ks, {r('LEAST(1e0, GREATEST(0e0, SUM(2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END)'
    ' * EXP(-2 * k * k * ks * ks * (nr * 1e0 * nc / (nr + nc))))))')} AS ks_p"
    " FROM ordered CROSS JOIN range(1, 101) AS t(k) GROUP BY c",
    q.DRIFT_NUMERIC, [], _ORDERED,
)
ORACLES["drift_wasserstein"] = _drift(
    f"SELECT c AS \"column\", {r('w1')} AS w1, {r('w1 / GREATEST(sd, 0.001)')} AS wasserstein FROM ordered",
    q.DRIFT_NUMERIC, [], _ORDERED,
)
ORACLES["drift_js"] = _drift(
    f"SELECT c AS \"column\", n_values, {r('js')} AS js FROM compared", [], q.DRIFT_CATEGORICAL, _SHARES
)


def _chi_square_sf(x: str, df: str) -> str:
    """Tail probability as one minus the sum of the incomplete gamma series, term by term."""
    a, y = f"({df} / 2e0)", f"({x} / 2e0)"
    return f"GREATEST(0e0, 1 - SUM(EXP(({a} + k) * LN({y}) - {y} - LGAMMA({a} + k + 1))))"


ORACLES["drift_chi2"] = _drift(
    f"SELECT c AS \"column\", {r('MAX(chi2)')} AS chi2, CASE WHEN MAX(new_share) > 0 THEN 0e0 WHEN MAX(n_values) < 2 THEN NULL"
    f" ELSE {r(_chi_square_sf('chi2', '(n_values - 1)'))} END AS chi2_p, {r('MAX(new_share)')} AS new_share"
    " FROM compared CROSS JOIN range(0, 500) AS t(k) GROUP BY c",
    [], q.DRIFT_CATEGORICAL, _SHARES,
)
ORACLES["drift_ztest"] = _drift(
    f"SELECT c AS \"column\", ref_rows, cur_rows, {r('MAX(z)')} AS z, {r(_chi_square_sf('(z * z)', '1'))} AS z_p"
    " FROM compared CROSS JOIN range(0, 500) AS t(k) GROUP BY c, ref_rows, cur_rows",
    ["tolls_amount"], ["store_and_fwd_flag"], _SHARES,
)
ORACLES["drift_columns"] = _drift(
    f"SELECT c AS \"column\", is_numeric, ref_rows, cur_rows, n_values, {r('new_share')} AS new_share, method, {r('score')} AS score,"
    " 'distance' AS score_kind, 0.1e0 AS threshold, score >= 0.1 AS drifted,"
    f" (SELECT COUNT(*) FROM silver WHERE year({P}) <= {q.REFERENCE_UNTIL}) - ref_rows AS ref_missing,"
    f" (SELECT COUNT(*) FROM silver WHERE year({P}) > {q.REFERENCE_UNTIL}) - cur_rows AS cur_missing,"
    " (ref_rows = 0) <> (cur_rows = 0) AS emptied FROM detected",
    q.DRIFT_NUMERIC, q.DRIFT_CATEGORICAL, _ALL,
)
_share = "COUNT(*) FILTER (WHERE score >= 0.1) * 1e0 / COUNT(*)"
_target = "MAX(CASE WHEN c = 'trip_duration_min' THEN score END)"
ORACLES["drift_summary"] = _drift(
    f"SELECT COUNT(*) AS n_columns, COUNT(*) FILTER (WHERE score >= 0.1) AS n_drifted, {r(_share)} AS share_drifted,"
    " COALESCE(STRING_AGG(CASE WHEN score >= 0.1 THEN c END, ',' ORDER BY c), '') AS drifted_columns,"
    f" {r(_target)} AS target_score, 'distance' AS target_score_kind, 0.1e0 AS target_threshold,"
    " COALESCE(STRING_AGG(CASE WHEN (ref_rows = 0) <> (cur_rows = 0) THEN c END, ',' ORDER BY c), '') AS emptied_columns,"
    " COUNT(*) FILTER (WHERE score >= 0.1) > 0 AS dataset_drift FROM detected",
    q.DRIFT_NUMERIC, q.DRIFT_CATEGORICAL, _ALL,
)
ORACLES["drift_gate"] = _drift(
    f"SELECT {r('share')} AS share_drifted, {r('target')} AS target_score, concat_ws('; ',"
    " CASE WHEN share > 0.3 THEN printf('share_of_drifted_columns %.2f%% > threshold 30.00%%', share * 100) END,"
    " CASE WHEN target >= 0.1 THEN printf('target_drift distance %.4f >= threshold 0.1', target) END) AS violations,"
    " NOT (share > 0.3 OR target >= 0.1) AS passed, (share > 0.3 OR target >= 0.1) AS retrain"
    f" FROM (SELECT {_share} AS share, {_target} AS target FROM detected)",
    q.DRIFT_NUMERIC, q.DRIFT_CATEGORICAL, _ALL,
)

# --- scoring -------------------------------------------------------------------------------

RAW_REQUESTS = f"SELECT {_select(fixtures.REQUEST_COLUMNS)}, {KEY} FROM {ORDER_LINES}"
REQUESTS = (
    f"SELECT {KEY}, TRY_CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime, "
    + ", ".join(
        f"CAST({'COALESCE(' + name + ', ' + (repr(default)) + ')' if default is not None else name} AS "
        f"{ {'int': 'INTEGER', 'double': 'DOUBLE', 'string': 'VARCHAR'}[kind] }) AS {name}"
        for name, kind, default in schema.REQUEST_FIELDS[1:]
    )
    + ", concat_ws(',', CASE WHEN TRY_CAST(pickup_datetime AS TIMESTAMP) IS NULL THEN 'pickup_datetime' END,"
    " CASE WHEN PULocationID IS NULL THEN 'PULocationID' END, CASE WHEN trip_distance < 0 THEN 'trip_distance' END,"
    " CASE WHEN passenger_count > 9 THEN 'passenger_count' END, CASE WHEN tolls_amount < 0 THEN 'tolls_amount' END) AS broken_rules"
    " FROM raw_requests"
)
ORACLES["validate_requests"] = f"WITH raw_requests AS ({RAW_REQUESTS}) {REQUESTS}"

from tripflow.operators import score  # noqa: E402

REQUEST_BASE = {**time_parts("pickup_datetime"), **time_flags("pickup_datetime"),
                **{k: v[len("(ROUND(") : -len(", 6) + 0e0)")] for k, v in cyclical("pickup_datetime").items()}, **DISTANCE, **ROUTE, **FEES}
_request_select = []
for _name in schema.FEATURES:
    if _name in score.COUNT_COLUMNS:
        expr = "0e0"
    elif _name.endswith("_encoded"):
        expr = f"CAST({score.DEFAULT_MEAN_TARGET} AS DOUBLE)"
    elif _name in schema.SCALED_COLUMNS:
        mean, std = score.DEFAULT_SCALING[_name]
        expr = r(f"({REQUEST_BASE.get(_name, _name)} - CAST({mean} AS DOUBLE)) / CAST({std} AS DOUBLE)")
    elif _name in _BOOLEANS:
        expr = f"CAST({REQUEST_BASE[_name]} AS INTEGER)"
    elif _name == "store_and_fwd_flag":
        expr = FLAG
    elif _name in ONEHOT:
        expr = ONEHOT[_name]
    else:
        expr = r(REQUEST_BASE[_name]) if _name in _DOUBLES else REQUEST_BASE.get(_name, _name)
    _request_select.append(f"{expr} AS {_name}")
ORACLES["request_features"] = (
    f"WITH raw_requests AS ({RAW_REQUESTS}), requests AS ({REQUESTS})"
    f" SELECT {KEY}, {', '.join(_request_select)} FROM requests WHERE broken_rules = ''"
)
_lookups = {
    f"by_{count}": f"SELECT {key} AS k, AVG({count}) AS n FROM gold_split WHERE split = 'train' GROUP BY 1"
    for count, key in score.COUNT_KEYS.items()
}
_request_route = ROUTE["route_id"]
ORACLES["score_lookup_features"] = over(
    "gold_split",
    f"SELECT {KEY}, "
    + ", ".join(f"{r(f'(COALESCE(by_{c}.n, {c}_mean) - {c}_mean) / {c}_std')} AS {c}" for c in score.COUNT_COLUMNS)
    + f", {_select(_encodings)} FROM (SELECT *, {_request_route} AS route_id FROM requests WHERE broken_rules = '') s"
    + "".join(f" LEFT JOIN by_{c} ON by_{c}.k = s.{k}" for c, k in score.COUNT_KEYS.items())
    + f" {MEANS_JOIN} CROSS JOIN stats",
    **ML, **_lookups, raw_requests=RAW_REQUESTS, requests=REQUESTS,
)
_aligned = {"store_and_fwd_flag": FLAG, "passenger_count": "passenger_count", "trip_distance": "trip_distance", "is_same_zone": ROUTE["is_same_zone"]}
ORACLES["align_features"] = over(
    "silver", f"SELECT {KEY}, {_select({f: _aligned.get(f, '0') for f in schema.FEATURES})} FROM silver"
)

# --- monitoring ----------------------------------------------------------------------------

LOG = f"SELECT {_select(fixtures.PREDICTION_LOG_COLUMNS)} FROM events"
LABELLED = (
    "SELECT ts, 'requests' AS metric, endpoint AS label FROM log UNION ALL"
    " SELECT ts, 'errors' AS metric, error_type AS label FROM log WHERE error_type IS NOT NULL"
)
SLIDING = (
    "SELECT *, time_bucket(INTERVAL '1' MINUTE, ts) - k * INTERVAL '1' MINUTE AS window_start,"
    " time_bucket(INTERVAL '1' MINUTE, ts) - k * INTERVAL '1' MINUTE + INTERVAL '5' MINUTE AS window_end"
    " FROM {} CROSS JOIN range(0, 5) AS t(k)"
)


def log(body: str) -> str:
    return f"WITH log AS ({LOG}), labelled AS ({LABELLED}) {body}"


def bucket(step: str) -> str:
    return f"time_bucket(INTERVAL {step}, ts) AS window_start, time_bucket(INTERVAL {step}, ts) + INTERVAL {step} AS window_end"


def _histogram(keys: str, value: str, bounds: list[float], source: str = "log", extra: str = "", groups: str = "") -> str:
    parts = [
        f"SELECT {keys}, {extra}'{b}' AS le, COUNT(*) FILTER (WHERE {value} <= {b}) AS cumulative FROM {source} GROUP BY {groups}"
        for b in bounds
    ]
    parts.append(f"SELECT {keys}, {extra}'+Inf' AS le, COUNT({value}) AS cumulative FROM {source} GROUP BY {groups}")
    return " UNION ALL ".join(parts)


ORACLES["request_totals"] = log("SELECT metric, label, COUNT(*) AS total FROM labelled GROUP BY 1, 2")
ORACLES["request_rate_5m"] = log(
    f"SELECT window_start, window_end, metric, label, {r('COUNT(*) / 300e0')} AS per_second"
    f" FROM ({SLIDING.format('labelled')}) GROUP BY 1, 2, 3, 4"
)
ORACLES["success_rate"] = log(
    "SELECT window_start, window_end, COUNT(*) AS requests, COUNT(error_type) AS errors,"
    f" {r('100 * (1 - (COUNT(error_type) / 300e0) / GREATEST(COUNT(*) / 300e0, 0.001))')} AS success_percent"
    f" FROM ({SLIDING.format('log')}) GROUP BY 1, 2"
)
ORACLES["latency_histogram"] = log(_histogram("endpoint", "latency_s", monitor.REQUEST_LATENCY_BUCKETS, groups="endpoint"))
ORACLES["stage_latency_histogram"] = log(_histogram("endpoint", "latency_s", monitor.STAGE_LATENCY_BUCKETS, groups="endpoint"))
_bounds = ", ".join(f"({i}, {low}e0, {high}e0)" for i, (low, high) in enumerate(
    zip([0, *monitor.REQUEST_LATENCY_BUCKETS[:-1]], monitor.REQUEST_LATENCY_BUCKETS)))
_quantile = (
    "SELECT w, {q} AS q, COALESCE(MIN_BY(low + (high - low) * ({q} * total - below) / (upto - below), i)"
    " FILTER (WHERE upto >= {q} * total), 5e0) AS v FROM filled GROUP BY w"
)
ORACLES["latency_quantiles"] = (
    f"WITH log AS ({LOG}), bounds(i, low, high) AS (VALUES {_bounds}),"
    " windows AS (SELECT time_bucket(INTERVAL '5' MINUTE, ts) AS w, latency_s FROM log),"
    " filled AS (SELECT w, i, low, high, COUNT(*) AS total, COUNT(*) FILTER (WHERE latency_s <= high) AS upto,"
    " CASE WHEN i = 0 THEN 0 ELSE COUNT(*) FILTER (WHERE latency_s <= low) END AS below"
    " FROM windows CROSS JOIN bounds GROUP BY w, i, low, high),"
    f" answers AS ({' UNION ALL '.join(_quantile.format(q=f'{x}e0') for x in ('0.5', '0.95', '0.99'))})"
    " SELECT w AS window_start, w + INTERVAL '5' MINUTE AS window_end, "
    + ", ".join(f"{r(f'MAX(CASE WHEN q = {x} THEN v END)')} AS {n}" for n, x in (("p50", "0.5"), ("p95", "0.95"), ("p99", "0.99")))
    + " FROM answers GROUP BY w"
)
_hour = bucket("'1' HOUR")
ORACLES["prediction_histogram"] = log(
    _histogram(_hour, "prediction_min", monitor.PREDICTION_BUCKETS, groups="1, 2")
)
ORACLES["batch_size_stats"] = log(
    _histogram(
        _hour, "batch_size", monitor.BATCH_SIZE_BUCKETS, "(SELECT * FROM log WHERE endpoint = '/predict/batch')",
        f"{r('AVG(batch_size)')} AS mean_size, ", "1, 2",
    )
)
ORACLES["prediction_shift_1h"] = (
    f"WITH log AS ({LOG}), means AS (SELECT {bucket(chr(39) + '5' + chr(39) + ' MINUTE')},"
    " (SUM(prediction_min) / 300e0) / GREATEST(COUNT(prediction_min) / 300e0, 0.001) AS m FROM log GROUP BY 1, 2)"
    f" SELECT a.window_start, a.window_end, {r('a.m')} AS mean_prediction, {r('b.m')} AS mean_prediction_before,"
    f" {r('a.m - b.m')} AS shift FROM means a LEFT JOIN means b ON b.window_start + INTERVAL '1' HOUR = a.window_start"
)
ORACLES["throughput_5m"] = log(
    f"SELECT window_start, window_end, CAST(SUM(batch_size) AS BIGINT) AS predictions, {r('SUM(batch_size) / 300e0')} AS per_second"
    f" FROM ({SLIDING.format('log')}) GROUP BY 1, 2"
)
ORACLES["monitor_stream"] = log(
    f"SELECT {bucket(chr(39) + '5' + chr(39) + ' MINUTE')}, endpoint, COUNT(*) AS requests, COUNT(error_type) AS errors,"
    f" CAST(SUM(batch_size) AS BIGINT) AS predictions, {r('SUM(prediction_min)')} AS prediction_sum FROM log"
    " GROUP BY 1, 2, 3 HAVING time_bucket(INTERVAL '5' MINUTE, ANY_VALUE(ts)) + INTERVAL '5' MINUTE"
    " <= (SELECT MAX(ts) FROM log) - INTERVAL '10' MINUTE"
)

# --- the log arriving in files -------------------------------------------------------------

for _name in ("request_totals", "latency_histogram"):
    ORACLES[f"{_name}_stream"] = ORACLES[_name]
ORACLES["prediction_shift_stream"] = ORACLES["prediction_shift_1h"]
_second = "CAST(floor(epoch(ts)) AS BIGINT)"
_five = bucket("'5' MINUTE")
# Late: the window had closed by what the files before had shown.
ARRIVED = (
    f"arrived AS (SELECT log.*, {_five}, CAST(CASE WHEN event_id % {q.STRAGGLER} = 0 THEN {q.ARRIVALS - 1} ELSE"
    f" floor(({_second} - low) * {q.ARRIVALS - 1} / (high - low + 1)) END AS BIGINT) AS batch"
    f" FROM log CROSS JOIN (SELECT MIN({_second}) AS low, MAX({_second}) AS high FROM log)),"
    " seen AS (SELECT b.batch, MAX(a.ts) AS seen FROM (SELECT DISTINCT batch FROM arrived) b JOIN arrived a"
    " ON a.batch < b.batch GROUP BY b.batch),"
    " judged AS (SELECT arrived.*, COALESCE(window_end <= seen - INTERVAL '10' MINUTE, FALSE) AS late"
    " FROM arrived LEFT JOIN seen USING (batch))"
)
ORACLES["activity_stream"] = (
    f"WITH log AS ({LOG}), {ARRIVED} SELECT window_start, window_end, endpoint, COUNT(*) AS requests,"
    f" COUNT(error_type) AS errors, CAST(SUM(batch_size) AS BIGINT) AS predictions, {r('SUM(prediction_min)')} AS prediction_sum,"
    " window_end > (SELECT MAX(ts) FROM log) - INTERVAL '10' MINUTE AS open FROM judged WHERE NOT late GROUP BY ALL"
)
ORACLES["late_activity"] = f"WITH log AS ({LOG}), {ARRIVED} SELECT event_id, ts, endpoint, batch FROM judged WHERE late"
