"""Monitoring a prediction log in event time.

Every function takes a batch or a streaming frame. A streaming frame needs a watermark
(``with_watermark``); its aggregates come out in append mode. In batch, sliding windows
are built from one-minute sums, so a log row is not copied once per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: bucket bounds and rate window ---
REQUEST_LATENCY_BUCKETS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]
STAGE_LATENCY_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25]
PREDICTION_BUCKETS = [1, 2, 5, 10, 15, 20, 30, 45, 60, 90, 120]
BATCH_SIZE_BUCKETS = [1, 2, 5, 10, 20, 50, 100]
RATE_FLOOR = 0.001
RATE_WINDOW, RATE_SLIDE, RATE_SECONDS = "5 minutes", "1 minute", 300.0
BATCH_ENDPOINT = "/predict/batch"


def with_watermark(log: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Event time as a zoned timestamp (a watermark needs one), late by at most ``delay``."""
    return log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def _window_columns(df: DataFrame) -> DataFrame:
    """``window`` as two zone-free timestamps."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )


def sliding_sums(log: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Sums per key in 5-minute windows that start every minute."""
    aggregates = [F.sum(value).alias(name) for name, value in sums.items()]
    window = F.window("ts", RATE_WINDOW, RATE_SLIDE)
    if log.isStreaming:
        return _window_columns(log.groupBy(window.alias("window"), *keys).agg(*aggregates))
    minutes = log.groupBy(F.window("ts", RATE_SLIDE)["start"].alias("ts"), *keys).agg(*aggregates)
    return _window_columns(
        minutes.groupBy(window.alias("window"), *keys).agg(*[F.sum(name).alias(name) for name in sums])
    )


def _totals_rows(log: DataFrame, *keep: str) -> DataFrame:
    """Each request as a row (metric, label) by endpoint, and one more by error type if it failed."""
    rows = F.array(
        F.struct(F.lit("requests").alias("metric"), F.col("endpoint").alias("label")),
        F.struct(F.lit("errors").alias("metric"), F.col("error_type").alias("label")),
    )
    return log.select(*keep, F.inline(rows)).where("label IS NOT NULL")


def request_totals(log: DataFrame) -> DataFrame:
    """Requests by endpoint and errors by type; as a stream in complete mode."""
    return _totals_rows(log).groupBy("metric", "label").agg(F.count("*").alias("total"))


def request_rate(log: DataFrame) -> DataFrame:
    """Requests per second by endpoint and errors per second by type, over 5 minutes."""
    counts = sliding_sums(_totals_rows(log, "ts"), ["metric", "label"], {"n": F.lit(1)})
    return counts.withColumn("per_second", F.col("n") / F.lit(RATE_SECONDS)).drop("n")


def success_rate(log: DataFrame) -> DataFrame:
    """100 × (1 − error rate / request rate), the request rate floored."""
    counts = sliding_sums(log, [], {"requests": F.lit(1), "errors": F.col("error_type").isNotNull().cast("int")})
    request_rate_, error_rate = F.col("requests") / F.lit(RATE_SECONDS), F.col("errors") / F.lit(RATE_SECONDS)
    percent = F.lit(100.0) * (F.lit(1.0) - error_rate / F.greatest(request_rate_, F.lit(RATE_FLOOR)))
    return counts.withColumn("success_percent", percent)


# --- histograms ----------------------------------------------------------------------------


def _bucket_counts(value: Column, bounds: list[float]) -> list[Column]:
    """Cumulative counts ``_le_0`` … and ``_le_inf``, all from one pass."""
    counts = [F.count_if(value <= bound).alias(f"_le_{i}") for i, bound in enumerate(bounds)]
    return [*counts, F.count(value).alias("_le_inf")]


def _bucket_rows(df: DataFrame, keys: list[str], bounds: list[float], extra: list[str] | None = None) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(str(b)).alias("le"), F.col(f"_le_{i}").alias("cumulative")) for i, b in enumerate(bounds)],
        F.struct(F.lit("+Inf").alias("le"), F.col("_le_inf").alias("cumulative")),
    )
    return df.select(*keys, *(extra or []), F.inline(rows))


def latency_histogram(log: DataFrame, bounds: list[float] = REQUEST_LATENCY_BUCKETS) -> DataFrame:
    counted = log.groupBy("endpoint").agg(*_bucket_counts(F.col("latency_s"), bounds))
    return _bucket_rows(counted, ["endpoint"], bounds)


def _interpolated(q: float, bounds: list[float]) -> Column:
    """Quantile from cumulative bucket counts, linear inside the bucket; the last bound for the open one."""
    rank = F.lit(q) * F.col("_le_inf")
    result = F.when(F.col("_le_inf") == 0, F.lit(None).cast("double"))
    for i, high in enumerate(bounds):
        low = F.lit(0.0) if i == 0 else F.lit(float(bounds[i - 1]))
        below = F.lit(0) if i == 0 else F.col(f"_le_{i - 1}")
        inside = F.col(f"_le_{i}") - below
        value = low + (F.lit(float(high)) - low) * F.try_divide(rank - below, inside)
        result = result.when(F.col(f"_le_{i}") >= rank, value)
    return result.otherwise(F.lit(float(bounds[-1])))


def latency_quantiles(
    log: DataFrame, window: str = RATE_WINDOW, quantiles: tuple[float, ...] = (0.50, 0.95, 0.99),
    bounds: list[float] = REQUEST_LATENCY_BUCKETS,
) -> DataFrame:
    """p50/p95/p99 per window, interpolated from the buckets."""
    counted = log.groupBy(F.window("ts", window).alias("window")).agg(*_bucket_counts(F.col("latency_s"), bounds))
    return _window_columns(
        counted.select("window", *[_interpolated(q, bounds).alias(f"p{round(q * 100)}") for q in quantiles])
    )


def prediction_histogram(log: DataFrame, window: str = "1 hour") -> DataFrame:
    """Predicted minutes per hour as cumulative buckets."""
    counted = log.groupBy(F.window("ts", window).alias("window")).agg(
        *_bucket_counts(F.col("prediction_min"), PREDICTION_BUCKETS)
    )
    return _bucket_rows(_window_columns(counted), ["window_start", "window_end"], PREDICTION_BUCKETS)


def batch_size_stats(log: DataFrame, window: str = "1 hour") -> DataFrame:
    """Batch sizes per hour: cumulative buckets and the mean, the request rate floored."""
    batches = log.where(F.col("endpoint") == BATCH_ENDPOINT)
    counted = batches.groupBy(F.window("ts", window).alias("window")).agg(
        *_bucket_counts(F.col("batch_size"), BATCH_SIZE_BUCKETS), F.avg("batch_size").alias("mean_size")
    )
    return _bucket_rows(_window_columns(counted), ["window_start", "window_end"], BATCH_SIZE_BUCKETS, ["mean_size"])


# --- shift and throughput ------------------------------------------------------------------


def window_means(log: DataFrame, window: str = RATE_WINDOW) -> DataFrame:
    """Mean prediction per window: rate of the sum over the floored rate of the count."""
    counted = log.groupBy(F.window("ts", window).alias("window")).agg(
        F.sum("prediction_min").alias("_sum"), F.count("prediction_min").alias("_n")
    )
    mean = (F.col("_sum") / F.lit(RATE_SECONDS)) / F.greatest(F.col("_n") / F.lit(RATE_SECONDS), F.lit(RATE_FLOOR))
    return _window_columns(counted.select("window", mean.alias("mean_prediction")))


def prediction_shift(log: DataFrame, back: str = "1 hour") -> DataFrame:
    """Mean prediction of each window beside the mean of the window ``back`` before it; batch only.

    Each window gives its mean to itself and to the later window, so one scan of the log and
    one small shuffle of windows do; a self join would aggregate the log twice.
    """
    later = F.expr(f"INTERVAL {back}")
    none = F.lit(None).cast("double")

    def given(shift: Column | None) -> Column:
        start, end = F.col("window_start"), F.col("window_end")
        return F.struct(
            (start if shift is None else start + shift).alias("window_start"),
            (end if shift is None else end + shift).alias("window_end"),
            F.lit(shift is None).alias("_own"),
            (F.col("mean_prediction") if shift is None else none).alias("mean_prediction"),
            (none if shift is None else F.col("mean_prediction")).alias("mean_prediction_before"),
        )

    both = window_means(log).select(F.inline(F.array(given(None), given(later))))
    compared = both.groupBy("window_start", "window_end").agg(
        F.max("_own").alias("_own"),
        F.max("mean_prediction").alias("mean_prediction"),
        F.max("mean_prediction_before").alias("mean_prediction_before"),
    )
    return _with_shift(compared.where("_own").drop("_own"))


def compare_with_earlier(means: DataFrame, earlier: DataFrame, back: str = "1 hour") -> DataFrame:
    """New window means beside those of a table of earlier ones, such as a stream's sink."""
    before = earlier.select(
        (F.col("window_start") + F.expr(f"INTERVAL {back}")).alias("window_start"),
        F.col("mean_prediction").alias("mean_prediction_before"),
    )
    return _with_shift(means.join(before, "window_start", "left"))


def _with_shift(compared: DataFrame) -> DataFrame:
    return compared.withColumn("shift", F.col("mean_prediction") - F.col("mean_prediction_before"))


def throughput(log: DataFrame) -> DataFrame:
    """Predictions per second over 5 minutes: the exact sum of batch sizes."""
    sums = sliding_sums(log, [], {"predictions": F.col("batch_size")})
    return sums.withColumn("per_second", F.col("predictions") / F.lit(RATE_SECONDS))


def endpoint_activity(log: DataFrame, window: str = RATE_WINDOW) -> DataFrame:
    """Tumbling summary per endpoint, the shape the stream writes: one row per closed window."""
    counted = log.groupBy(F.window("ts", window).alias("window"), "endpoint").agg(
        F.count("*").alias("requests"),
        F.count("error_type").alias("errors"),
        F.sum("batch_size").alias("predictions"),
        F.sum("prediction_min").alias("prediction_sum"),
    )
    return _window_columns(counted)
