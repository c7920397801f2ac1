"""The named queries: one per operator, over the star-schema tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import partial, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import fixtures, schema
from tripflow.functions import time, trip
from tripflow.operators import drift, encode, gold, metrics, models, profile, score, silver, split, validate
from tripflow.sources import records, storage
from tripflow.streaming import monitor, run

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = fixtures.TRIP_KEY

# Settings shared with the checking SQL.
COMMITTED_UNTIL, FAILED_YEAR = 1996, 1997
REPLACED_YEAR, EMPTIED_YEAR, GONE_YEAR = 1994, 1996, 1997
REFERENCE_UNTIL = 1998
SAMPLE_FRACTION, SEED, TRAIN_SHARE = 0.1, 42, 0.8
CAP = 1000
REQUIRED_EXAMPLE = ["l_orderkey", "l_quantity", "o_orderkey", "o_orderdate"]
# The tuning query ends when all of its fits are done, however long they take.
TUNING_SECONDS = None
GATE = {"min_r2": 0.0, "max_rmse": 54.0, "max_mae": 46.0}
DRIFT_NUMERIC = [
    "passenger_count", "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount", "trip_duration_min",
]
DRIFT_CATEGORICAL = ["VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, columns: list[str] | None = None, places: int = 6) -> DataFrame:
    """Fewer places for values that engines compute with different last bits."""
    names = columns or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, places) for c in names})


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.trips(spark, sf, with_key=True)


def _silver(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return silver.clean(fixtures.trips(spark, sf, with_key=bool(keep)), keep=keep)


def _silver_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Silver with the trip key, written as the pipeline does: what follows reads it several times.

    Reading a written layer also keeps the generated code of cleaning and of feature
    engineering in separate stages; fused, the method is too long for the JVM to compile.
    """
    return storage.written(silver.clean(_trips(spark, sf), keep=KEY), "silver")


# --- flagship ------------------------------------------------------------------------------


@query
def zone_hour_summary(spark: SparkSession, sf: str) -> DataFrame:
    trips = gold.route_features(_silver(spark, sf))
    return rounded(
        trips.groupBy("PULocationID", F.hour(schema.PICKUP).alias("pickup_hour")).agg(
            F.count("*").alias("trips"), F.avg(schema.TARGET).alias("mean_duration_min")
        ),
        places=8,  # means of sixtieths over small groups end at the seventh place, where engines round apart
    )


# --- scans, sources, sinks -----------------------------------------------------------------


@query
def scan_trips(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.trips(spark, sf)


@query
def file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return storage.file_inventory(spark, sf, "*.parquet")


@query
def land_months(spark: SparkSession, sf: str) -> DataFrame:
    trips = fixtures.trips(spark, sf).withColumn(storage.SOURCE, F.date_format(schema.PICKUP, "yyyy-MM"))
    return storage.land_months(trips, storage.shared_path(spark, "bronze"), rebalance=True).drop(storage.SOURCE)


def _ledger(months: DataFrame) -> DataFrame:
    """Months up to 1996 committed, those of 1997 failed."""
    status = F.when(F.col("year") <= COMMITTED_UNTIL, "committed").otherwise("failed")
    return months.where(F.col("year") <= FAILED_YEAR).withColumn("status", status)


@query
def pending_partitions(spark: SparkSession, sf: str) -> DataFrame:
    months = storage.month_counts(storage.with_month(fixtures.trips(spark, sf)))
    return storage.pending_partitions(months, _ledger(months))


@query
def refresh_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Two refreshes of silver from a written bronze: first the old years, then whatever is missing."""
    bronze_path, ledger, out = (storage.shared_path(spark, n) for n in ("bronze", "ledger", "silver"))
    storage.write_layer(storage.with_month(fixtures.trips(spark, sf)), bronze_path, rebalance=True)
    bronze = storage.scan_layer(spark, bronze_path)
    storage.refresh_layer(bronze.where(F.col("year") <= COMMITTED_UNTIL), ledger, out, silver.clean)
    storage.refresh_layer(bronze, ledger, out, silver.clean)
    committed = spark.read.schema(schema.LEDGER).parquet(ledger)
    written_rows = storage.month_counts(storage.scan_layer(spark, out)).withColumnRenamed("rows", "silver_rows")
    return committed.join(written_rows, storage.PARTITIONS, "left").select(
        "year", "month", F.col("rows").alias("bronze_rows"), "status", F.coalesce("silver_rows", F.lit(0)).alias("silver_rows")
    )


@query
def refresh_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """All silver rows after three refreshes of a changing bronze, with how often their month was committed.

    The second finds one year's distances halved (as many rows as before), another's fares all invalid, a third
    gone, and the rest rewritten as it was; the third finds the invalid year as it first was.
    """
    first, second, ledger, out = (storage.shared_path(spark, n) for n in ("bronze", "bronze", "ledger", "silver"))
    clean = partial(silver.clean, keep=KEY)
    trips = storage.with_month(_trips(spark, sf))
    storage.write_layer(trips, first, rebalance=True)
    bronze = storage.scan_layer(spark, first)
    storage.refresh_layer(bronze, ledger, out, clean)

    halved = F.when(F.col("year") == REPLACED_YEAR, F.col("trip_distance") / 2).otherwise(F.col("trip_distance"))
    invalid = F.when(F.col("year") == EMPTIED_YEAR, -1.0).otherwise(F.col("fare_amount"))
    changed = bronze.where(F.col("year") != GONE_YEAR).withColumns({"trip_distance": halved, "fare_amount": invalid})
    storage.write_layer(changed, second)
    storage.refresh_layer(storage.scan_layer(spark, second), ledger, out, clean)

    storage.write_layer(bronze.where(F.col("year") == EMPTIED_YEAR), second)
    storage.refresh_layer(storage.scan_layer(spark, second), ledger, out, clean)
    versions = spark.read.schema(schema.REFRESH_LEDGER).parquet(ledger).select(*storage.PARTITIONS, "version")
    return storage.scan_layer(spark, out).join(versions, storage.PARTITIONS)


@query
def stage_records(spark: SparkSession, sf: str) -> DataFrame:
    """What landing, a refresh and a failing validation left as records."""
    log, landed, base, ledger, out = (storage.shared_path(spark, n) for n in ("runs", "landed", "bronze", "ledger", "silver"))
    run_of = records.Run(spark, log, "stage_records")
    trips = fixtures.trips(spark, sf).withColumn(storage.SOURCE, F.date_format(schema.PICKUP, "yyyy-MM"))
    storage.land_months(trips, landed, rebalance=True, run=run_of)
    by_month = storage.scan_layer(spark, landed).drop(storage.SOURCE)
    storage.write_layer(by_month, base)
    storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, silver.clean, run=run_of)
    with suppress(ValueError):
        validate.validation_stage(storage.list_files(spark, sf), REQUIRED_EXAMPLE, run_of)
    found = profile.latest_stage_run(spark.read.schema(schema.STAGE_RUNS).parquet(log), ["created_at_utc", "run_id"])
    rows, number = F.col("data_rows"), F.col("metrics")
    return found.select(
        "stage",
        "status",
        F.coalesce(rows["read"], rows["found"], rows["files"]).cast("long").alias("rows_read"),
        rows["written"].cast("long").alias("rows_written"),
        F.coalesce(number["months"], number["sources"], number["failed_files"]).cast("long").alias("parts"),
        F.split("error", ":")[0].alias("error"),
    )


@query
def write_layer(spark: SparkSession, sf: str) -> DataFrame:
    path = storage.shared_path(spark, "silver")
    storage.write_layer(storage.with_month(_silver(spark, sf)), path, rebalance=True)
    written = storage.scan_layer(spark, path)
    return rounded(
        written.groupBy(*storage.PARTITIONS).agg(
            F.count("*").alias("rows"), F.sum("fare_amount").alias("fares"), F.max("tip_amount").alias("highest_tip")
        )
    )


@query
def cap_rows(spark: SparkSession, sf: str) -> DataFrame:
    trips = _trips(spark, sf).select(*KEY, schema.PICKUP, "trip_distance")
    return storage.cap_rows(trips, CAP, [schema.PICKUP, *KEY])


@query
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    trips = _trips(spark, sf).select(*KEY, "trip_distance", "fare_amount")
    return storage.sample_rows(trips, SAMPLE_FRACTION, KEY, SEED)


@query
def feature_target_view(spark: SparkSession, sf: str) -> DataFrame:
    trips = _silver(spark, sf).select(schema.TARGET, "trip_distance", "passenger_count", "PULocationID", "DOLocationID")
    return storage.feature_target_view(trips)


# --- validation ----------------------------------------------------------------------------


@query
def validate_columns(spark: SparkSession, sf: str) -> DataFrame:
    report = validate.validate_columns(storage.list_files(spark, sf), REQUIRED_EXAMPLE)
    return report.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), F.array_join("missing", ",").alias("missing"), "status"
    )


@query
def validate_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = [validate.validate_counts(fixtures.table(spark, sf, name), max_rows=2_000_000) for name in fixtures.TABLES]
    return reduce(DataFrame.unionByName, counts).drop("file_path")


@query
def rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    return validate.trip_violations(fixtures.trips(spark, sf))


@query
def quarantine_trips(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = validate.accepted_and_quarantined(silver.with_duration(_trips(spark, sf)), validate.trip_rules())
    return bad.select(*KEY, F.array_join("broken_rules", ",").alias("broken_rules"))


# --- silver --------------------------------------------------------------------------------


@query
def trip_duration(spark: SparkSession, sf: str) -> DataFrame:
    return silver.with_duration(_trips(spark, sf)).select(*KEY, schema.TARGET)


@query
def silver_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf)


@query
def impute_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return silver.impute_defaults(_trips(spark, sf)).select(*KEY, *schema.NULL_DEFAULTS)


@query
def clamp_rate_code(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clamp_rate_code(_trips(spark, sf)).select(*KEY, "RatecodeID")


@query
def cap_tip(spark: SparkSession, sf: str) -> DataFrame:
    return silver.cap_tip(_trips(spark, sf)).select(*KEY, "fare_amount", "tip_amount")


# --- gold ----------------------------------------------------------------------------------


def _pickup_columns(spark: SparkSession, sf: str, columns: dict[str, Column]) -> DataFrame:
    return _trips(spark, sf).select(*KEY, *[c.alias(name) for name, c in columns.items()])


@query
def time_parts(spark: SparkSession, sf: str) -> DataFrame:
    return _pickup_columns(spark, sf, time.time_parts(F.col(schema.PICKUP)))


@query
def time_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _pickup_columns(spark, sf, time.time_flags(F.col(schema.PICKUP)))


@query
def cyclical_time(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_pickup_columns(spark, sf, time.cyclical_time(F.col(schema.PICKUP))))


@query
def distance_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_pickup_columns(spark, sf, trip.distance_features(F.col("trip_distance"))))


@query
def route_features(spark: SparkSession, sf: str) -> DataFrame:
    return gold.route_features(_trips(spark, sf)).select(*KEY, "PULocationID", "DOLocationID", "route_id", "is_same_zone")


@query
def fare_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return _pickup_columns(spark, sf, trip.fare_ratios())


@query
def fee_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _pickup_columns(
        spark, sf, {**trip.fee_flags(), "non_fare_amount": F.col("total_amount") - F.col("fare_amount")}
    )


@query
def zone_trip_counts(spark: SparkSession, sf: str) -> DataFrame:
    return gold.zone_trip_counts(_silver(spark, sf), "PULocationID", "pickup_zone_trip_count")


@query
def dropoff_trip_counts(spark: SparkSession, sf: str) -> DataFrame:
    return gold.zone_trip_counts(_silver(spark, sf), "DOLocationID", "dropoff_zone_trip_count")


@query
def route_trip_counts(spark: SparkSession, sf: str) -> DataFrame:
    return gold.route_trip_counts(_silver(spark, sf))


TRANSCENDENTAL = ["sin_hour", "cos_hour", "sin_day_of_week", "cos_day_of_week", "log_trip_distance"]


@query
def gold_trips(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gold.engineer(_silver_layer(spark, sf)).drop(*KEY), TRANSCENDENTAL)


# --- encode, scale, split ------------------------------------------------------------------


def _split_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold with key and split, written without the leaking columns: the fits below read it several times."""
    trips = _silver_layer(spark, sf)
    labelled = split.time_split(gold.engineer(trips), thresholds=split.split_thresholds(trips))
    return storage.written(labelled.drop(*schema.LEAKAGE_COLUMNS), "gold")


def _split_silver(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Key, pickup time, the columns and the split. Nothing is written but the counts per pickup second."""
    trips = silver.clean(_trips(spark, sf), keep=KEY)
    return split.time_split(trips.select(*KEY, schema.PICKUP, *columns), thresholds=split.split_thresholds(trips))


@query
def category_levels(spark: SparkSession, sf: str) -> DataFrame:
    return encode.category_levels(_silver(spark, sf))


@query
def target_means(spark: SparkSession, sf: str) -> DataFrame:
    train = _split_silver(spark, sf, *schema.TARGET_ENCODED_COLUMNS, schema.TARGET).where("split = 'train'")
    return rounded(encode.target_means(train, schema.TARGET_ENCODED_COLUMNS))


_SCALED_FROM = [c for c in schema.SILVER_COLUMNS if c in schema.SCALED_COLUMNS or c == "trip_distance"]


def _with_scaled(trips: DataFrame) -> DataFrame:
    """Trips with all columns that are scaled: distance features, and zone and route counts of the whole month.

    The trips are read twice: pass a written table.
    """
    counts = storage.written(gold.count_lookup(trips), "trip-counts")
    months = dict(zip(gold.MONTH, (F.year(schema.PICKUP), F.month(schema.PICKUP))))
    return gold.with_counts(gold.distance_features(trips.withColumns(months)), counts)


@query
def scaling_stats(spark: SparkSession, sf: str) -> DataFrame:
    trips = storage.written(_silver(spark, sf).select(schema.PICKUP, *gold.ZONES, *_SCALED_FROM), "silver")
    return rounded(encode.scaling_stats(_with_scaled(trips)))


@query
def split_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return split.split_thresholds(fixtures.trips(spark, sf))


@query
def time_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split_silver(spark, sf).select(*KEY, schema.PICKUP, "split")


@query
def random_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.random_split(_trips(spark, sf).select(*KEY), KEY, TRAIN_SHARE, SEED)


@query
def union_splits(spark: SparkSession, sf: str) -> DataFrame:
    rows = _split_silver(spark, sf, "trip_distance", schema.TARGET).drop(schema.PICKUP)
    return split.union_splits(rows.where("split = 'train'"), rows.where("split = 'val'"))


@query
def drop_leakage(spark: SparkSession, sf: str) -> DataFrame:
    return encode.drop_leakage(_silver(spark, sf)).drop(schema.DROPOFF)


@query
def encode_binary(spark: SparkSession, sf: str) -> DataFrame:
    return encode.encode_binary(_trips(spark, sf).select(*KEY, "store_and_fwd_flag"))


@query
def encode_onehot(spark: SparkSession, sf: str) -> DataFrame:
    trips = _split_silver(spark, sf, *schema.ONEHOT_COLUMNS)
    levels = encode.fit_levels(trips.where("split = 'train'"))
    return encode.encode_onehot(trips.select(*KEY, *schema.ONEHOT_COLUMNS), levels)


@query
def encode_target(spark: SparkSession, sf: str) -> DataFrame:
    columns = schema.TARGET_ENCODED_COLUMNS
    trips = _split_silver(spark, sf, *columns, schema.TARGET)
    means = storage.written(encode.target_means(trips.where("split = 'train'"), columns), "target-means")
    return rounded(encode.encode_target(trips.select(*KEY, *columns), means, columns))


@query
def scale_features(spark: SparkSession, sf: str) -> DataFrame:
    silver_rows = _silver(spark, sf, *KEY).select(*KEY, schema.PICKUP, *gold.ZONES, *_SCALED_FROM)
    labelled = split.time_split(narrow := storage.written(silver_rows, "silver"), thresholds=split.split_thresholds(narrow))
    # Written: the statistics and the rows would each repeat the join of the counts.
    trips = storage.written(_with_scaled(labelled).select(*KEY, "split", *schema.SCALED_COLUMNS), "scaled-from")
    stats = encode.fit_scaling(trips.where("split = 'train'"))
    return rounded(encode.scale_features(trips, stats).select(*KEY, *stats))


@query
def ml_table(spark: SparkSession, sf: str) -> DataFrame:
    table, _ = encode.model_table(_split_gold(spark, sf))
    return rounded(table.select(*schema.FEATURES, schema.TARGET, "split"))


@query
def fitted_state(spark: SparkSession, sf: str) -> DataFrame:
    """The state as stored beside the splits and read back."""
    table, encoders = encode.model_table(_split_gold(spark, sf))
    path = storage.shared_path(spark, "model-table")
    encode.save_model_table(table, encoders, path)
    return rounded(encode.load_encoders(spark, path).as_rows())


@query
def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    table, _ = encode.model_table(_split_gold(spark, sf))
    vectors = models.assemble(table).select(models.LABEL, vector_to_array(models.VECTOR).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return rounded(vectors.select("label", F.size("v").alias("n_features"), total.alias("feature_sum")))


# --- profiles and run records --------------------------------------------------------------


@query
def profile_table(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_table(_silver(spark, sf))


@query
def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.profile_columns(fixtures.trips(spark, sf)), ["min", "max", "mean", "stddev"])


@query
def profile_by_month(spark: SparkSession, sf: str) -> DataFrame:
    months = storage.with_month(_silver(spark, sf))
    return rounded(profile.profile_columns(months, by=["year", "month"]), ["mean", "stddev"])


@query
def schema_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return profile.content_fingerprint(_silver(spark, sf))


@query
def latest_stage_run(spark: SparkSession, sf: str) -> DataFrame:
    return profile.latest_stage_run(fixtures.stage_runs(spark, sf), ["created_at", "run_id"])


@query
def run_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.run_rollup(fixtures.stage_runs(spark, sf), ["stage", "pipeline_run_id"]), ["duration_seconds"])


# --- metrics, gates, comparison ------------------------------------------------------------


def _predictions(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """Rows (model, actual, predicted) of the named stand-in models, or all three, beside two segments."""
    pairs = [
        F.struct(F.lit(name).alias("model"), F.expr(fixtures.MODEL_COLUMNS[name]).cast("double").alias("predicted"))
        for name in names or fixtures.MODEL_COLUMNS
    ]
    return _silver(spark, sf).select(
        F.col(schema.TARGET).alias("actual"), "payment_type", F.col("PULocationID").alias("zone"), F.inline(F.array(*pairs))
    )


@query
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.regression_metrics(_predictions(spark, sf), "actual", "predicted", ["model"]))


@query
def metrics_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.regression_metrics(_predictions(spark, sf), "actual", "predicted", ["model", "payment_type"]))


@query
def evaluator_metrics(spark: SparkSession, sf: str) -> DataFrame:
    one = _predictions(spark, sf, "by_distance").select("actual", "predicted")
    with models.persisted(one):
        found = models.evaluator_metrics(one, "actual", "predicted")
    return rounded(spark.createDataFrame([found], "rmse double, mae double, r2 double"))


@query
def leaderboard_topn(spark: SparkSession, sf: str) -> DataFrame:
    by_segment = metrics.regression_metrics(_predictions(spark, sf), "actual", "predicted", ["model", "payment_type"])
    return rounded(metrics.leaderboard(by_segment, 2, ["payment_type"]))


def _zone_metrics(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Metrics per zone of the new and the old model, from one aggregate over the trips."""
    rows = _predictions(spark, sf, "by_distance", "by_fare")
    both = storage.written(metrics.regression_metrics(rows, "actual", "predicted", ["model", "zone"]), "zone-metrics")
    new, old = (both.where(F.col("model") == m).drop("model") for m in ("by_distance", "by_fare"))
    return new, old


@query
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    rows = _predictions(spark, sf, "by_distance")
    gate = metrics.quality_gate(metrics.regression_metrics(rows, "actual", "predicted", ["zone"]), **GATE)
    return rounded(gate.withColumn("violations", F.array_join("violations", "; ")), ["rmse", "mae", "r2"])


@query
def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    """The distance model against the fare model, zone by zone."""
    return rounded(metrics.compare_models(*_zone_metrics(spark, sf), ["zone"]))


@query
def promotion_decision(spark: SparkSession, sf: str) -> DataFrame:
    new, old = _zone_metrics(spark, sf)
    gate = metrics.quality_gate(new, **GATE)
    return metrics.promotion_decision(metrics.compare_models(new, old, ["zone"]), gate, ["zone"]).drop("violations")


# --- models --------------------------------------------------------------------------------


@query
def feature_contract(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["trip_distance", "passenger_count", "PULocationID"]
    rows = _split_silver(spark, sf, *wanted, schema.TARGET)
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    train, val = models.feature_contract(train, val, wanted, [schema.TARGET, "split"])
    return train.unionByName(val)


def _assembled_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, encode.Encoders, DataFrame]:
    """Assembled rows of all splits with their key, encoders, gold."""
    table = _split_gold(spark, sf)
    encoded, encoders = encode.model_table(table)
    # Written: fits and counts below would otherwise repeat the encoding joins.
    rows = storage.written(models.assemble(encoded).select(*KEY, models.VECTOR, models.LABEL, "split"), "assembled")
    return rows, encoders, table


def _assembled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, encode.Encoders, DataFrame]:
    """Assembled training and validation rows with their key, encoders, gold."""
    rows, encoders, table = _assembled_rows(spark, sf)
    return rows.where("split = 'train'"), rows.where("split = 'val'"), encoders, table


@query
def fit_linear(spark: SparkSession, sf: str) -> DataFrame:
    train, val, _, _ = _assembled(spark, sf)
    estimator = models.LinearRegression(
        featuresCol=models.VECTOR, labelCol=models.LABEL, maxIter=50, regParam=0.1, elasticNetParam=0.0
    )
    model = estimator.fit(train)
    weights = [("intercept", float(model.intercept)), *zip(schema.FEATURES, map(float, model.coefficients))]
    return spark.createDataFrame(weights, "term string, weight double")


@query
def fit_family(spark: SparkSession, sf: str) -> DataFrame:
    train, val, _, _ = _assembled(spark, sf)
    model = models.fit("decision_tree", {"max_depth": 8, "min_samples_leaf": 10}, train)
    return models.score_metrics(model, val).withColumn("model", F.lit("decision_tree"))


@query
def train_and_score(spark: SparkSession, sf: str) -> DataFrame:
    train, val, _, _ = _assembled(spark, sf)
    params = {**models.SCREENING_PARAMS["random_forest"], "random_state": 42}
    return models.score_metrics(models.fit("random_forest", params, train), val)


@query
def early_stopping(spark: SparkSession, sf: str) -> DataFrame:
    train, val, _, _ = _assembled(spark, sf)
    model = models.fit("lightgbm", models.SCREENING_PARAMS["lightgbm"], train, val)
    return models.score_metrics(model, val).withColumn("trees", F.lit(model.getNumTrees))


@query
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    train, _, _, _ = _assembled(spark, sf)
    return models.feature_importance(spark, models.fit("decision_tree", {"max_depth": 6}, train))


@query
def screen_families(spark: SparkSession, sf: str) -> DataFrame:
    train, val, _, _ = _assembled(spark, sf)
    return models.screen_families(train, val)


@query
def tune_family(spark: SparkSession, sf: str) -> DataFrame:
    train, val, _, _ = _assembled(spark, sf)
    tuned = models.tune_family(
        "random_forest", train, val, KEY, parallelism=4, halving=models.HALVING, seconds=TUNING_SECONDS
    )
    return tuned.trials.drop("params").withColumn("best_val_rmse", F.lit(tuned.val_metrics["rmse"]))


@query
def champion(spark: SparkSession, sf: str) -> DataFrame:
    """The best of four families on validation rows, stored with its test metrics, and loaded again to score the test rows.

    ``different`` counts test rows that the loaded model predicts otherwise than the fitted one.
    """
    rows, _, _ = _assembled_rows(spark, sf)
    train, val, test = (rows.where(F.col("split") == s) for s in ("train", "val", "test"))
    families = ("ridge", "lasso", "elasticnet", "decision_tree")
    # Each fit reads the written rows. Kept in memory, vectors take a buffer for every ten thousand rows, beyond what Spark accounts for.
    found = [models.candidate(f, models.SCREENING_PARAMS[f], train, val) for f in families]
    store = models.ModelStore(spark, storage.shared_path(spark, "models"))
    record = models.champion(found, test, store)
    winner = next(c for c in found if c.family == record.first()["family"])
    fitted = winner.model.setPredictionCol("fitted").transform(test)
    both = store.load().setPredictionCol("loaded").transform(fitted)
    differing = both.agg(F.count("*").alias("scored"), F.count_if(F.col("fitted") != F.col("loaded")).alias("different"))
    numbers = [F.col("metrics")[f"{side}_{m}"].alias(f"{side}_{m}") for side in ("val", "test") for m in ("rows", "rmse", "mae", "r2")]
    # One row on either side.
    return record.select("version", "family", "params", *numbers, F.lit(1).alias("_one")).join(
        differing.withColumn("_one", F.lit(1)), "_one"
    ).drop("_one")


# --- drift ---------------------------------------------------------------------------------


def _frequencies(spark: SparkSession, sf: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    sides = _silver(spark, sf).withColumn("is_reference", F.year(schema.PICKUP) <= REFERENCE_UNTIL)
    return drift.column_frequencies(sides, numeric, categorical)


@query
def drift_ks(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.ordered_statistics(_frequencies(spark, sf, DRIFT_NUMERIC, []))
    return rounded(stats.select("column", "ks", "ks_p"))


@query
def drift_wasserstein(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.ordered_statistics(_frequencies(spark, sf, DRIFT_NUMERIC, []))
    return rounded(stats.select("column", "w1", "wasserstein"))


@query
def drift_js(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.share_statistics(_frequencies(spark, sf, [], DRIFT_CATEGORICAL))
    return rounded(stats.select("column", "n_values", "js"))


@query
def drift_chi2(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.share_statistics(_frequencies(spark, sf, [], DRIFT_CATEGORICAL))
    return rounded(stats.select("column", "chi2", "chi2_p", "new_share"))


@query
def drift_ztest(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.share_statistics(_frequencies(spark, sf, ["tolls_amount"], ["store_and_fwd_flag"]))
    return rounded(stats.select("column", "ref_rows", "cur_rows", "z", "z_p"))


@query
def drift_columns(spark: SparkSession, sf: str) -> DataFrame:
    found = drift.drift_columns(_frequencies(spark, sf, DRIFT_NUMERIC, DRIFT_CATEGORICAL))
    return rounded(found)


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    columns = drift.drift_columns(_frequencies(spark, sf, DRIFT_NUMERIC, DRIFT_CATEGORICAL))
    return drift.drift_summary(columns, schema.TARGET)


@query
def drift_summary(spark: SparkSession, sf: str) -> DataFrame:
    lists = {c: F.array_join(c, ",") for c in ("drifted_columns", "emptied_columns")}
    return rounded(_summary(spark, sf).withColumns(lists))


@query
def drift_gate(spark: SparkSession, sf: str) -> DataFrame:
    gate = drift.drift_gate(_summary(spark, sf))
    return rounded(gate.select("share_drifted", "target_score", F.array_join("violations", "; ").alias("violations"), "passed", "retrain"))


# --- scoring -------------------------------------------------------------------------------


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return score.validate_requests(fixtures.request_json(spark, sf))


@query
def validate_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _requests(spark, sf).withColumn("broken_rules", F.array_join("broken_rules", ","))


@query
def request_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(score.model_features(score.accepted(_requests(spark, sf)), keep=KEY))


@query
def score_lookup_features(spark: SparkSession, sf: str) -> DataFrame:
    table = _split_gold(spark, sf)
    _, encoders = encode.model_table(table)
    lookups = score.fit_lookups(table.where("split = 'train'"))
    features = score.model_features(score.accepted(_requests(spark, sf)), encoders, lookups, keep=KEY)
    return rounded(features.select(*KEY, *score.COUNT_COLUMNS, "DOLocationID_encoded", "PULocationID_encoded"))


@query
def align_features(spark: SparkSession, sf: str) -> DataFrame:
    trips = gold.route_features(encode.encode_binary(silver.clean(_trips(spark, sf), keep=KEY)))
    return encode.align_features(trips, keep=KEY)


def _scorer(spark: SparkSession, sf: str) -> Callable[[DataFrame], DataFrame]:
    """A linear model trained on the training split, as a function from request JSON to predictions."""
    train, _, encoders, table = _assembled(spark, sf)
    model = models.fit("ridge", {"alpha": 1.0}, train)
    lookups = score.fit_lookups(table.where("split = 'train'"))

    def apply(requests: DataFrame) -> DataFrame:
        good = score.accepted(score.validate_requests(requests))
        return score.predict(model, score.model_features(good, encoders, lookups, keep=KEY), KEY)

    return apply


@query
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _scorer(spark, sf)(fixtures.request_json(spark, sf))


@query
def score_stream(spark: SparkSession, sf: str) -> DataFrame:
    scorer = _scorer(spark, sf)
    lines = run.read_files(spark, sf, fixtures.table(spark, sf, "lineitem").schema, "lineitem.parquet")
    return run.score_stream(fixtures.request_json_from(lines, fixtures.table(spark, sf, "orders")), scorer)


# --- monitoring ----------------------------------------------------------------------------


def _monitor(name: str, fn: Callable[[DataFrame], DataFrame], round_columns: list[str] | None = None) -> None:
    def run_query(spark: SparkSession, sf: str) -> DataFrame:
        result = fn(fixtures.prediction_log(spark, sf))
        return rounded(result, round_columns) if round_columns else result

    run_query.__name__ = name
    query(run_query)


_monitor("request_totals", monitor.request_totals)
_monitor("request_rate_5m", monitor.request_rate, ["per_second"])
_monitor("success_rate", monitor.success_rate, ["success_percent"])
_monitor("latency_histogram", monitor.latency_histogram)
_monitor("latency_quantiles", monitor.latency_quantiles, ["p50", "p95", "p99"])
_monitor("prediction_histogram", monitor.prediction_histogram)
_monitor("prediction_shift_1h", monitor.prediction_shift, ["mean_prediction", "mean_prediction_before", "shift"])
_monitor("batch_size_stats", monitor.batch_size_stats, ["mean_size"])
_monitor("throughput_5m", monitor.throughput, ["per_second"])


@query
def stage_latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.latency_histogram(fixtures.prediction_log(spark, sf), monitor.STAGE_LATENCY_BUCKETS)


@query
def monitor_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = run.read_files(spark, sf, fixtures.table(spark, sf, "events").schema, "events.parquet")
    return rounded(run.monitor_stream(fixtures.prediction_log_from(events)), ["prediction_sum"])


#: Parts the log arrives in below: of its time span in order, then stragglers from all of it.
ARRIVALS, STRAGGLER = 4, 50


def _arrive(spark: SparkSession, sf: str, folder: str, arrival: int) -> None:
    """Let one part of the log arrive in ``folder``, as many files as tasks read it."""
    events = storage.spread(fixtures.table(spark, sf, "events"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    span = events.agg(F.min(seconds).alias("low"), F.max(seconds).alias("high")).first()
    part = F.floor((seconds - span["low"]) * (ARRIVALS - 1) / (span["high"] - span["low"] + 1))
    arrived = F.when(F.col("event_id") % STRAGGLER == 0, ARRIVALS - 1).otherwise(part)
    events.where(arrived == arrival).write.mode("append").parquet(folder)


def _restarted(spark: SparkSession, sf: str, start: Callable[[DataFrame], DataFrame | None]) -> DataFrame | None:
    """Run ``start`` on the log's stream each time another part has arrived; every run goes on where the last one ended.

    A run takes all files of the part that arrived in one micro-batch.
    """
    folder, found = storage.shared_path(spark, "log"), None
    kind = fixtures.table(spark, sf, "events").schema
    for arrival in range(ARRIVALS):
        _arrive(spark, sf, folder, arrival)
        found = start(fixtures.prediction_log_from(run.read_files(spark, folder, kind)))
    return found


def _upserted(spark: SparkSession, sf: str, summary: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    out, checkpoint = storage.shared_path(spark, "totals"), storage.shared_path(spark, "totals-checkpoint")
    return _restarted(spark, sf, lambda log: run.upsert_stream(summary(log), out, checkpoint, keys))


@query
def request_totals_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, monitor.request_totals, ["metric", "label"])


@query
def latency_histogram_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, monitor.latency_histogram, ["endpoint", "le"])


@query
def prediction_shift_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing is late here: the delay spans the log, as stragglers come from all of it."""
    out, checkpoint = storage.shared_path(spark, "shift"), storage.shared_path(spark, "shift-checkpoint")
    found = _restarted(spark, sf, lambda log: run.shift_stream(log, out, checkpoint, delay="100 days"))
    return rounded(found, ["mean_prediction", "mean_prediction_before", "shift"])


def _activity(spark: SparkSession, sf: str) -> str:
    out, checkpoint = storage.shared_path(spark, "activity"), storage.shared_path(spark, "activity-checkpoint")
    _restarted(spark, sf, lambda log: run.activity_stream(log, out, checkpoint))
    return out


@query
def activity_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Every window of the log with its state, open ones too."""
    return rounded(run.activity(spark, _activity(spark, sf)), ["prediction_sum"])


@query
def late_activity(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that came after their window had closed."""
    return run.late_activity(spark, _activity(spark, sf)).select("event_id", "ts", "endpoint", "batch")
