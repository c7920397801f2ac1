"""Streaming runs: file source → the batch functions → parquet tables with a checkpoint.

The sinks below keep what each micro-batch gave in a folder of its own, named after the batch and written as a whole.
A batch that runs again after a crash, which reads the same files, replaces its own folder: nothing is lost or doubled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripflow.sources.storage import read_if_there, shared_path
from tripflow.streaming import monitor


def read_files(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
               max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def run_available(stream: DataFrame, out: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Process what is there, then stop. Restarting with the same checkpoint goes on where it ended."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(out)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped in the query's recent batches, counted after partial aggregation."""
    return sum(
        operator.numRowsDroppedByWatermark for progress in query.recentProgress for operator in progress.stateOperators
    )


def _run_to_table(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    out = shared_path(spark, name)
    run_available(stream, out, shared_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def monitor_stream(log: DataFrame, summary: Callable[[DataFrame], DataFrame] = monitor.endpoint_activity,
                   delay: str = "10 minutes") -> DataFrame:
    """Run a windowed summary over a log stream; windows the watermark has closed, as a table.

    Rows later than ``delay`` are dropped; ``late_rows`` counts them for a query of your own.
    """
    return _run_to_table(summary(monitor.with_watermark(log, delay)), "monitor")


def prediction_shift_stream(log: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The shift against one hour before, over the window means the stream has written."""
    means = monitor_stream(log, monitor.window_means, delay)
    return monitor.compare_with_earlier(means, means)


def score_stream(
    requests: DataFrame, score: Callable[[DataFrame], DataFrame], out: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Run the batch scoring function over a request stream (it holds no state between rows).

    With ``out`` and ``checkpoint`` a run that was stopped or lost goes on with the files it has not scored; the sink
    commits whole micro-batches once each. ``read_files`` bounds the files of a micro-batch. Without them both are new.
    """
    if (out is None) != (checkpoint is None):
        raise ValueError("a run that can go on needs both its out folder and its checkpoint")
    if out is None:
        return _run_to_table(score(requests), "scores")
    scored = score(requests)
    run_available(scored, out, checkpoint)
    return scored.sparkSession.read.schema(scored.schema).parquet(out)


# --- tables by batch -----------------------------------------------------------------------

BATCH = "batch"


def _put(rows: DataFrame, table: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")


def _get(spark: SparkSession, table: str, kind: T.StructType) -> DataFrame:
    """All batches of a table so far, with their number; no rows before the first."""
    whole = T.StructType([*kind, T.StructField(BATCH, T.LongType())])
    found = read_if_there(spark, table, whole)
    return spark.createDataFrame([], whole) if found is None else found


def _run_batches(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the row of the newest batch, nulls being a key; combined before the shuffle."""
    rest = [c for c in rows.columns if c not in [*keys, BATCH]]
    newest = F.max_by(F.struct(*rest), BATCH).alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[f"_newest.{c}" for c in rest])


def upsert_stream(summary: DataFrame, out: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Run an unwindowed summary of a stream in update mode, and give it as it stands now.

    Each micro-batch writes the rows that changed; the newest of a key holds. What is counted lives in the
    checkpoint's state, so a run that starts again with it goes on counting.
    """
    _run_batches(summary, lambda rows, batch_id: _put(rows, out, batch_id), checkpoint, "update")
    return latest(_get(summary.sparkSession, out, summary.schema), keys).select(*summary.columns)


def shift_stream(log: DataFrame, out: str, checkpoint: str, delay: str = "10 minutes", back: str = "1 hour") -> DataFrame:
    """The shift of the window means against those ``back`` earlier, kept up to date batch by batch.

    Means come from the stream's state, in update mode. A mean that changed alters its own window's shift and that of
    the window ``back`` later, so each batch reads the means of these windows from the sink and writes their shifts.
    """
    means = monitor.window_means(monitor.with_watermark(log, delay))
    spark, kind, step = log.sparkSession, means.schema, F.expr(f"INTERVAL {back}")
    shifts = T.StructType([*kind, T.StructField("mean_prediction_before", T.DoubleType()), T.StructField("shift", T.DoubleType())])

    def each(changed: DataFrame, batch_id: int) -> None:
        session = changed.sparkSession
        _put(changed, f"{out}/means", batch_id)
        known = _get(session, f"{out}/means", kind)
        now = known.where(F.col(BATCH) == batch_id).select("window_start")
        ends = now.agg(F.min("window_start").alias("low"), F.max("window_start").alias("high")).first()
        if ends["low"] is None:
            return
        # Windows from one step before the first changed one to one step after the last: a range the files prune by.
        near = known.where(
            (F.col("window_start") >= F.lit(ends["low"]) - step) & (F.col("window_start") <= F.lit(ends["high"]) + step)
            & (F.col(BATCH) <= batch_id)
        )
        near = latest(near, ["window_start", "window_end"])
        touched = now.union(now.select(F.col("window_start") + step)).distinct()
        _put(monitor.compare_with_earlier(near.join(touched, "window_start"), near, back), f"{out}/shifts", batch_id)

    _run_batches(means, each, checkpoint, "update")
    return latest(_get(spark, f"{out}/shifts", shifts), ["window_start", "window_end"])


# --- windows with late rows ----------------------------------------------------------------

PROGRESS = T.StructType([T.StructField("highest", T.TimestampNTZType()), T.StructField("rows", T.LongType()), T.StructField("late", T.LongType())])
ACTIVITY_KEYS = ["window_start", "window_end", "endpoint"]


def _closed(until: Column, delay: str, end: Column) -> Column:
    """Whether a window that ends at ``end`` is closed once events up to ``until`` were seen."""
    return F.coalesce(end <= until - F.expr(f"INTERVAL {delay}"), F.lit(False))


def activity_stream(
    log: DataFrame, out: str, checkpoint: str, delay: str = "10 minutes", window: str = monitor.RATE_WINDOW
) -> None:
    """Activity per endpoint and window, with every late row kept and counted.

    A window closes when an earlier micro-batch has seen an event ``delay`` or more after its end. A row of a closed window
    is late: it goes to a side table as it came. All others are added up per batch, window and endpoint, and these sums
    add up to the windows. Nothing else is held between batches, so a lost run goes on from its tables. Rows without a time
    have no window and count as late.
    """

    def each(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        seen = _get(spark, f"{out}/progress", PROGRESS).where(F.col(BATCH) < batch_id).agg(F.max("highest")).first()[0]
        rows = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).persist()
        try:
            end = F.window("ts", window)["end"].cast("timestamp_ntz")
            timed = rows.where("ts IS NOT NULL").withColumn("_late", _closed(F.lit(seen).cast("timestamp_ntz"), delay, end))
            late = timed.where("_late").drop("_late").unionByName(rows.where("ts IS NULL"))
            _put(late, f"{out}/late", batch_id)
            _put(monitor.endpoint_activity(timed.where("NOT _late").drop("_late"), window), f"{out}/sums", batch_id)
            n_late = spark.read.schema(rows.schema).parquet(f"{out}/late/{BATCH}={batch_id}").count()
            found = rows.agg(F.max("ts").alias("highest"), F.count("*").alias("rows")).withColumn("late", F.lit(n_late).cast("long"))
            # Last: a batch without it is as if it had not been.
            _put(found, f"{out}/progress", batch_id)
        finally:
            rows.unpersist()

    _run_batches(log, each, checkpoint)


def activity(spark: SparkSession, out: str, delay: str = "10 minutes") -> DataFrame:
    """The windows so far: their sums, and whether they are still ``open``."""
    progress = _get(spark, f"{out}/progress", PROGRESS)
    seen = progress.agg(F.max("highest")).first()[0]
    sums = read_if_there(spark, f"{out}/sums")
    if sums is None:
        raise LookupError(f"no batch has run into {out}")
    values = [c for c in sums.columns if c not in [*ACTIVITY_KEYS, BATCH]]
    whole = sums.groupBy(*ACTIVITY_KEYS).agg(*[F.sum(c).alias(c) for c in values])
    return whole.withColumn("open", ~_closed(F.lit(seen).cast("timestamp_ntz"), delay, F.col("window_end")))


def late_activity(spark: SparkSession, out: str) -> DataFrame:
    """The late rows as they came, with their batch."""
    found = read_if_there(spark, f"{out}/late")
    if found is None:
        raise LookupError(f"no batch has run into {out}")
    return found.withColumn(BATCH, F.col(BATCH).cast("long"))


def batch_counts(spark: SparkSession, out: str) -> DataFrame:
    """Rows and late rows of each micro-batch, all of them."""
    return _get(spark, f"{out}/progress", PROGRESS).select(BATCH, "rows", "late")
