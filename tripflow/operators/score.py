"""Scoring requests: contract, features, fitted lookups, prediction. All row-wise, so batch and stream alike."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions import trip
from tripflow.operators import encode, gold
from tripflow.operators.models import PREDICTION, VECTOR, assemble
from tripflow.operators.validate import with_broken_rules
from tripflow.sources.storage import written

PICKUP = "pickup_datetime"

# --- fixed values: levels and statistics a server falls back to without fitted state ---
SERVING_LEVELS = {"VendorID": [2, 6], "RatecodeID": [2, 3, 4, 5, 6], "payment_type": [1, 2, 3, 4]}
DEFAULT_SCALING = {
    "trip_distance": (3.557, 3.868),
    "log_trip_distance": (1.256, 0.680),
    "sqrt_trip_distance": (1.673, 0.871),
    "passenger_count": (1.272, 0.710),
    "pickup_zone_trip_count": (104425.341, 48951.576),
    "dropoff_zone_trip_count": (73331.144, 43604.781),
    "route_trip_count": (2939.174, 2662.820),
}
DEFAULT_MEAN_TARGET = 16.975
COUNT_COLUMNS = ["pickup_zone_trip_count", "dropoff_zone_trip_count", "route_trip_count"]


# --- contract ------------------------------------------------------------------------------


def _step(df: DataFrame, columns: list[str | Column]) -> DataFrame:
    """The columns as a step of their own, computed once and before all that follows.

    As a plain projection they would be copied into the expressions and filters that use them, and the
    generated method of both together can be too long for the JVM to compile.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def parse_requests(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON text → one text column per field, ``raw_<field>``; an absent field is null.

    ``inline`` makes the parsed fields a step of their own. As a plain projection the parse
    would be copied into every expression and filter that uses a field.
    """
    fields = ", ".join(f"{name} STRING" for name, _, _ in schema.REQUEST_FIELDS)
    parsed = df.select(*[c for c in df.columns if c != value], F.inline(F.array(F.from_json(value, fields))))
    return parsed.withColumnsRenamed({name: f"raw_{name}" for name, _, _ in schema.REQUEST_FIELDS})


def _typed(name: str, kind: str) -> Column:
    text = F.col(f"raw_{name}")
    if kind == "timestamp_ntz":
        # Accepts both "2025-01-15T08:30:00" and the form with a blank.
        return text.try_cast("timestamp_ntz")
    return text if kind == "string" else text.try_cast(kind)


def _request_rules() -> dict[str, Column]:
    rules = {}
    for name, kind, default in schema.REQUEST_FIELDS:
        value, given = F.col(name), F.col(f"raw_{name}").isNotNull()
        broken = value.isNull() if default is None else given & value.isNull()
        low, high = schema.REQUEST_BOUNDS.get(name, (None, None))
        if kind == "double":
            broken = broken | F.coalesce(F.isnan(value), F.lit(False))
        if low is not None:
            broken = broken | F.coalesce(value < low, F.lit(False))
        if high is not None:
            broken = broken | F.coalesce(value > high, F.lit(False))
        rules[name] = broken
    return rules


def validate_requests(df: DataFrame, value: str = "value") -> DataFrame:
    """Typed request columns with defaults, and ``broken_rules``: names of the fields that are wrong.

    Missing, unreadable or out-of-bounds. Rows with any are for quarantine, the rest is accepted.
    """
    parsed = parse_requests(df, value)
    typed = _step(parsed, [*parsed.columns, *[_typed(name, kind).alias(name) for name, kind, _ in schema.REQUEST_FIELDS]])
    marked = with_broken_rules(typed, _request_rules())
    defaults = {
        name: F.coalesce(F.col(name), F.lit(default).cast(kind))
        for name, kind, default in schema.REQUEST_FIELDS
        if default is not None
    }
    return marked.withColumns(defaults).drop(*[f"raw_{name}" for name, _, _ in schema.REQUEST_FIELDS])


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("broken_rules") == 0).drop("broken_rules")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("broken_rules") > 0)


# --- features ------------------------------------------------------------------------------


def request_features(requests: DataFrame) -> DataFrame:
    """The same expressions as gold, on requests; flags as 0/1."""
    features = gold.route_features(gold.distance_features(gold.time_features(requests, PICKUP)))
    features = features.withColumns(trip.fee_flags())
    flags = [f.name for f in features.schema if f.dataType.simpleString() == "boolean"]
    features = features.withColumns({c: F.col(c).cast("int") for c in flags})
    return features.withColumn("is_same_zone", F.coalesce("is_same_zone", F.lit(0)))


# Which column of a request finds which count.
COUNT_KEYS = {
    "pickup_zone_trip_count": "PULocationID",
    "dropoff_zone_trip_count": "DOLocationID",
    "route_trip_count": "route_id",
}


def fit_lookups(train: DataFrame, target: str = schema.TARGET) -> dict[str, DataFrame]:
    """Mean training count per zone and route, and per zone the mean target; a written table each.

    One table per key, so a request is joined once per key. Small tables get broadcast.
    """
    lookups = {}
    for count, key in COUNT_KEYS.items():
        means = [F.avg(count).alias("_count")]
        if key in schema.TARGET_ENCODED_COLUMNS:
            means.append(F.avg(target).alias("_target"))
        known = train.where(F.col(key).isNotNull())
        lookups[count] = written(known.groupBy(F.col(key).alias("_key")).agg(*means), f"mean-{count}")
    return lookups


def with_lookups(features: DataFrame, encoders: encode.Encoders, lookups: dict[str, DataFrame]) -> DataFrame:
    """Counts and target encodings from the fitted tables; unseen zones and routes get the training means."""
    overall = encode.global_mean(encoders.means)
    for count, key in COUNT_KEYS.items():
        features = features.join(lookups[count], F.col(key) == F.col("_key"), "left").withColumn(
            count, F.coalesce("_count", F.lit(encoders.scaling[count][0]))
        )
        if key in encoders.target_columns:
            features = features.withColumn(f"{key}_encoded", F.coalesce("_target", overall))
        features = features.drop("_key", "_count", "_target")
    return features


def with_default_counts(features: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    return features.withColumns({c: F.lit(scaling[c][0]) for c in COUNT_COLUMNS})


def model_features(
    requests: DataFrame,
    encoders: encode.Encoders | None = None,
    lookups: dict[str, DataFrame] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Accepted requests → the model's features in order.

    With fitted state, zones use their own training means and counts. Without it every zone
    gets the mean (counts become 0 after scaling), as a server that stores no state does.
    """
    features = encode.encode_binary(request_features(requests))
    if encoders is None:
        scaling = DEFAULT_SCALING
        features = with_default_counts(features, scaling).withColumns(
            {f"{c}_encoded": F.lit(DEFAULT_MEAN_TARGET) for c in schema.TARGET_ENCODED_COLUMNS}
        )
        features = encode.encode_onehot(features, SERVING_LEVELS)
    else:
        scaling = encoders.scaling
        if lookups is None:
            features = with_default_counts(features, scaling)
            features = encode.encode_target(features, encoders.means, encoders.target_columns)
        else:
            features = with_lookups(features, encoders, lookups)
        features = encode.encode_onehot(features, encoders.levels)
    return encode.align_features(encode.scale_features(features, scaling), keep=keep)


# --- prediction ----------------------------------------------------------------------------


def predict(model: Model, features: DataFrame, keep: list[str]) -> DataFrame:
    """Predicted minutes: never below 0, rounded to 2 places. One row per request: null if a feature is missing."""
    scored = model.transform(assemble(_step(features, [*keep, *schema.FEATURES]), invalid="keep"))
    # Asked of the vector, as tests of all columns are long code too.
    whole = ~F.array_contains(vector_to_array(VECTOR), F.lit(float("nan")))
    minutes = F.when(whole, F.round(F.greatest(F.col(PREDICTION), F.lit(0.0)), 2))
    return scored.select(*keep, minutes.alias("predicted_duration_minutes"))
