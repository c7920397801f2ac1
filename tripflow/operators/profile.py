"""Table profiles, schema fingerprints and run records."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schema


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column (position, name, type, nullable) with the table's row and column count."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    counted = df.agg(F.count("*").alias("row_count"))
    return counted.select("row_count", F.lit(len(df.columns)).alias("column_count"), F.inline(fields))


def _column_aggregates(df: DataFrame, names: list[str]) -> list[Column]:
    """Aggregates of all columns for one pass. NaN is counted apart and kept out of the statistics."""
    aggregates = []
    for name in names:
        kind, value = df.schema[name].dataType, F.col(f"`{name}`")
        aggregates.append(F.count_if(value.isNull()).alias(f"{name}__nulls"))
        if isinstance(kind, T.NumericType):
            number = value
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                aggregates.append(F.count_if(F.isnan(value)).alias(f"{name}__nans"))
                number = F.when(~F.isnan(value), value)
            number = number.cast("double")
            aggregates += [
                F.min(number).alias(f"{name}__min"),
                F.max(number).alias(f"{name}__max"),
                F.avg(number).alias(f"{name}__mean"),
                F.stddev_samp(number).alias(f"{name}__stddev"),
            ]
    return aggregates


def profile_columns(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Null count of every column and min/max/mean/stddev of numeric ones, one row per column.

    All from one aggregate with map-side combine; ``by`` profiles each group, e.g. each month.
    """
    by = by or []
    names = [c for c in df.columns if c not in by]
    wide = df.groupBy(*by).agg(F.count("*").alias("_rows"), *_column_aggregates(df, names))
    known = set(wide.columns)

    def stat(name: str, suffix: str, empty: Column) -> Column:
        full = f"{name}__{suffix}"
        return (F.col(f"`{full}`") if full in known else empty).alias(suffix)

    none = F.lit(None).cast("double")
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col("_rows").alias("rows"),
                stat(name, "nulls", none),
                stat(name, "nans", F.lit(0).cast("bigint")),
                stat(name, "min", none),
                stat(name, "max", none),
                stat(name, "mean", none),
                stat(name, "stddev", none),
            )
            for name in names
        ]
    )
    return wide.select(*by, F.inline(rows))


def schema_fingerprint(df: DataFrame) -> str:
    """sha256 of the column names and types."""
    fields = [{"name": f.name, "dtype": f.dataType.simpleString()} for f in df.schema]
    return hashlib.sha256(json.dumps(fields, sort_keys=True).encode()).hexdigest()


def content_fingerprint(df: DataFrame) -> DataFrame:
    """Schema hash, row count and an order-free hash of all values; one row.

    A hash skips nulls, so where a row's nulls are is hashed with its values.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    row_hash = F.xxhash64(*columns, *[c.isNull() for c in columns]).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.sum(row_hash).cast("string").alias("content_hash")).select(
        F.lit(schema_fingerprint(df)).alias("schema_hash"), "rows", "content_hash"
    )


# --- run records ---------------------------------------------------------------------------


def stage_record(
    spark: SparkSession,
    stage: str,
    pipeline_run_id: str,
    run_id: str,
    created_at_utc: str,
    status: str = "success",
    data_rows: dict[str, str] | None = None,
    metrics: dict[str, str] | None = None,
    artifacts: dict[str, str] | None = None,
    error: str | None = None,
) -> DataFrame:
    def text(values: dict | None) -> dict[str, str]:
        return {str(k): str(v) for k, v in (values or {}).items()}

    row = (stage, pipeline_run_id, run_id, created_at_utc, status, text(data_rows), text(metrics), text(artifacts), error)
    return spark.createDataFrame([row], schema.STAGE_RUNS)


def append_stage_record(record: DataFrame, path: str) -> None:
    record.write.mode("append").partitionBy("stage").parquet(path)


def latest_stage_run(runs: DataFrame, order: list[str], stage: str = "stage") -> DataFrame:
    """The newest record of each stage: an aggregate with map-side combine, so a busy stage is no hot task."""
    rest = [c for c in runs.columns if c != stage]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_run")
    return runs.groupBy(stage).agg(newest).select(stage, *[F.col(f"_run.{c}").alias(c) for c in rest])


def run_rollup(runs: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """Counts by outcome, rows and duration per stage and run."""
    is_status = lambda name: F.count_if(F.col(status) == name)
    return runs.groupBy(*keys).agg(
        F.count("*").alias("inputs"),
        is_status("success").alias("processed"),
        is_status("skipped").alias("skipped"),
        is_status("failed").alias("failed"),
        F.sum(F.when(F.col(status) == "success", F.col("rows_processed"))).alias("rows_processed"),
        F.sum("duration_seconds").alias("duration_seconds"),
        F.when(F.count_if(F.col(status) == "failed") > 0, "failed").otherwise("success").alias("run_status"),
    )
