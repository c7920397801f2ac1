import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow import fixtures
from tripflow.plans import queries
from tripflow.streaming import monitor, run

NOON = dt.datetime(2025, 1, 1, 12)
LOG = ("event_id long, segment long, ts timestamp_ntz, endpoint string, error_type string, latency_s double,"
       " prediction_min double, batch_size long")


def log(spark, *rows):
    """Rows (minutes after noon, endpoint, error, latency, prediction, batch size)."""
    return spark.createDataFrame(
        [(i, 0, NOON + dt.timedelta(minutes=r[0]), *r[1:]) for i, r in enumerate(rows)], LOG)


SUMMARIES = [
    monitor.endpoint_activity, monitor.request_rate, monitor.success_rate, monitor.throughput, monitor.latency_quantiles,
    monitor.prediction_histogram, monitor.batch_size_stats, monitor.window_means,
]


@pytest.mark.parametrize("summary", SUMMARIES, ids=lambda f: f.__name__)
def test_stream_equals_batch(spark, sf, summary):
    """Over the same events a stream gives what the batch gives for the windows it has closed."""
    events = fixtures.table(spark, sf, "events")
    stream = run.read_files(spark, sf, events.schema, "events.parquet")
    streamed = run.monitor_stream(fixtures.prediction_log_from(stream), summary)
    closed = events.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    batch = summary(fixtures.prediction_log(spark, sf)).where(F.col("window_end") <= F.lit(closed))
    exact = lambda f: queries.rounded(f.select(sorted(batch.columns)))
    assert exact(batch).count() > 0
    assert exact(batch).exceptAll(exact(streamed)).isEmpty() and exact(streamed).exceptAll(exact(batch)).isEmpty()


def test_late_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "log")
    log(spark, (0, "/predict", None, 0.1, 5.0, 1), (60, "/predict", None, 0.1, 5.0, 1)).coalesce(1).write.parquet(folder)
    # The engine drops by the watermark of the batch before, so the late row comes two batches on.
    for rows in ([(65, "/predict", None, 0.1, 5.0, 1)],
                 [(1, "/predict", None, 0.1, 5.0, 1), (55, "/predict", None, 0.1, 5.0, 1), (120, "/predict", None, 0.1, 5.0, 1)]):
        log(spark, *rows).coalesce(1).write.mode("append").parquet(folder)
    stream = run.read_files(spark, folder, spark.read.parquet(folder).schema, max_files=1)
    out = str(tmp_path / "out")
    activity = monitor.endpoint_activity(monitor.with_watermark(stream))
    query = run.run_available(activity, out, str(tmp_path / "checkpoint"))
    assert run.late_rows(query) == 1
    found = {r.window_start: r.requests for r in spark.read.parquet(out).collect()}
    at = lambda minutes: NOON + dt.timedelta(minutes=minutes)
    # 12:01 came an hour late; 12:55 was within ten minutes of 13:00.
    assert found == {at(0): 1, at(55): 1, at(60): 1, at(65): 1}
    # The same checkpoint goes on after the files already read.
    log(spark, (180, "/predict", None, 0.1, 5.0, 1)).coalesce(1).write.mode("append").parquet(folder)
    run.run_available(activity, out, str(tmp_path / "checkpoint"))
    assert {r.window_start: r.requests for r in spark.read.parquet(out).collect()} == {**found, at(120): 1}


def test_request_totals_as_stream(spark, tmp_path):
    folder = str(tmp_path / "log")
    frame = log(spark, (0, "/predict", "KeyError", 0.1, None, 1), (1, "/predict", None, 0.1, 5.0, 1))
    frame.write.parquet(folder)
    running = (
        monitor.request_totals(run.read_files(spark, folder, frame.schema))
        .writeStream.outputMode("complete").format("memory").queryName("totals").trigger(availableNow=True).start()
    )
    running.awaitTermination()
    rows = {(r.metric, r.label): r.total for r in spark.table("totals").collect()}
    assert rows == {("requests", "/predict"): 2, ("errors", "KeyError"): 1}


def test_success_and_throughput(spark):
    frame = log(spark, (0, "/predict", None, 0.1, 5.0, 1), (1, "/predict", "KeyError", 0.1, None, 1),
                (2, "/predict/batch", None, 0.1, 5.0, 7))
    rows = {r.window_start: r for r in monitor.success_rate(frame).collect()}
    assert len(rows) == 7
    assert rows[NOON].success_percent == pytest.approx(100 * (1 - (1 / 300) / (3 / 300)))
    assert rows[NOON + dt.timedelta(minutes=2)].success_percent == 100.0
    assert {r.window_start: r.predictions for r in monitor.throughput(frame).collect()}[NOON] == 9


def test_histogram_and_quantiles(spark):
    latencies = [0.005] * 50 + [0.02] * 30 + [0.2] * 15 + [9.0] * 5
    frame = log(spark, *[(0, "/predict", None, v, None, 1) for v in latencies])
    counts = {r.le: r.cumulative for r in monitor.latency_histogram(frame).collect()}
    assert (counts["0.01"], counts["0.025"], counts["0.25"], counts["5.0"], counts["+Inf"]) == (50, 80, 95, 95, 100)
    row = monitor.latency_quantiles(frame).first()
    assert row.p50 == pytest.approx(0.01)
    assert row.p95 == pytest.approx(0.25)
    # The open bucket has no upper end: its quantile is the last bound.
    assert row.p99 == 5.0
    # Failed requests have no prediction and are in no prediction bucket.
    assert {r.cumulative for r in monitor.prediction_histogram(frame).collect()} == {0}


def test_prediction_shift(spark):
    frame = log(spark, (0, "/predict", None, 0.1, 10.0, 1), (1, "/predict", None, 0.1, 20.0, 1), (61, "/predict", None, 0.1, 18.0, 1))
    rows = {r.window_start: (r.mean_prediction, r.mean_prediction_before, r["shift"]) for r in monitor.prediction_shift(frame).collect()}
    assert rows[NOON] == (15.0, None, None)
    assert rows[NOON + dt.timedelta(hours=1)] == pytest.approx((18.0, 15.0, 3.0))


def test_prediction_shift_as_stream(spark, sf):
    events = fixtures.table(spark, sf, "events")
    stream = run.read_files(spark, sf, events.schema, "events.parquet")
    streamed = run.prediction_shift_stream(fixtures.prediction_log_from(stream))
    closed = events.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    batch = monitor.prediction_shift(fixtures.prediction_log(spark, sf)).where(F.col("window_end") <= F.lit(closed))
    exact = lambda f: queries.rounded(f.select(sorted(batch.columns)))
    assert exact(batch).where("shift IS NOT NULL").count() > 0
    assert exact(batch).exceptAll(exact(streamed)).isEmpty() and exact(streamed).exceptAll(exact(batch)).isEmpty()


def test_scores_of_stream_and_batch(spark, sf):
    """Request validation and features hold no state, so a stream of requests scores like a batch."""
    from tripflow.operators import score

    lines, orders = fixtures.table(spark, sf, "lineitem"), fixtures.table(spark, sf, "orders")
    features = lambda requests: score.model_features(score.accepted(score.validate_requests(requests)), keep=fixtures.TRIP_KEY)
    stream = run.read_files(spark, sf, lines.schema, "lineitem.parquet")
    streamed = run.score_stream(fixtures.request_json_from(stream, orders), features)
    batch = features(fixtures.request_json_from(lines, orders))
    assert batch.count() > 1000
    assert batch.exceptAll(streamed).isEmpty() and streamed.exceptAll(batch).isEmpty()
