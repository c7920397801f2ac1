"""Streams that are stopped, lost and started again: nothing lost, nothing doubled."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tripflow.plans import queries
from tripflow import fixtures
from tripflow.streaming import monitor, run

KIND = "event_id long, user_id long, ts timestamp_ntz, event_type string, value double"
START = dt.datetime(2025, 1, 1)


def events(spark, n=240, seed=1):
    draw = random.Random(seed)
    rows = [
        (i, i % 3, START + dt.timedelta(minutes=i, seconds=draw.randrange(60)), draw.choice(["purchase", "error", "view", "click"]),
         float(draw.randrange(1, 400)))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, KIND)


def arrive(frame, folder):
    frame.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def paths(tmp_path):
    return [str(tmp_path / n) for n in ("log", "out", "checkpoint")]


def stream(spark, folder):
    return fixtures.prediction_log_from(run.read_files(spark, folder, spark.createDataFrame([], KIND).schema, max_files=1))


def plain(frame, places=9):
    return sorted(
        (tuple(round(v, places) if isinstance(v, float) else v for v in r) for r in frame.collect()), key=str
    )


class Lost(Exception):
    pass


def losing(monkeypatch, name, batch_id, table=""):
    """The first write to a table from a batch on fails after the fact, as if the driver had gone then."""
    put, lost = run._put, []

    def failing(rows, path, number):
        put(rows, path, number)
        if number >= batch_id and table in path and not lost:
            lost.append(path)
            raise Lost

    monkeypatch.setattr(run, name, failing)
    return lost


@pytest.mark.parametrize("summary, keys", [(monitor.request_totals, ["metric", "label"]), (monitor.latency_histogram, ["endpoint", "le"])])
def test_totals_after_two_restarts_and_a_loss(spark, paths, monkeypatch, summary, keys):
    folder, out, checkpoint = paths
    whole = events(spark)
    lost = losing(monkeypatch, "_put", 1)
    for k in range(3):
        arrive(whole.where(F.col("event_id") % 3 == k), folder)
        start = lambda: run.upsert_stream(summary(stream(spark, folder)), out, checkpoint, keys)
        if k == 1:
            with pytest.raises(Exception, match="Lost"):
                start()
        found = start()
        so_far = fixtures.prediction_log_from(whole.where(F.col("event_id") % 3 <= k))
        assert plain(found) == plain(summary(so_far).select(*found.columns))
    assert lost


def test_shift_over_several_batches(spark, paths, monkeypatch):
    folder, out, checkpoint = paths
    whole = events(spark)
    lost = losing(monkeypatch, "_put", 1, "shifts")
    for k in range(3):
        # The last file changes means of windows that others were already compared with.
        arrive(whole.where((F.col("event_id") % 7 == 0) if k == 2 else (F.col("event_id") % 7 != 0) & (F.floor(F.col("event_id") / 120) == k)), folder)
        start = lambda: run.shift_stream(stream(spark, folder), out, checkpoint, delay="10 hours")
        if k == 1:
            with pytest.raises(Exception, match="Lost"):
                start()
        found = start()
    assert lost and found.where("mean_prediction_before IS NOT NULL").count() > 20
    assert plain(found) == plain(monitor.prediction_shift(fixtures.prediction_log_from(whole)).select(*found.columns))


def brute_late(files, delay=dt.timedelta(minutes=10)):
    seen, late = None, []
    for batch, rows in enumerate(files):
        for r in rows:
            end = START + (((r.ts - START) // dt.timedelta(minutes=5)) + 1) * dt.timedelta(minutes=5) if r.ts else None
            if r.ts is None or (seen is not None and end <= seen - delay):
                late.append((batch, r.event_id))
        seen = max([seen, *(r.ts for r in rows if r.ts)], key=lambda t: t or START)
    return late


@pytest.mark.parametrize("table", ["late", "sums", "progress"])
def test_late_rows_are_kept_and_counted(spark, paths, monkeypatch, table):
    folder, out, checkpoint = paths
    whole = events(spark, 90).withColumn("ts", F.when(F.col("event_id") != 70, F.col("ts")))
    parts = [
        whole.where("event_id BETWEEN 0 AND 39 AND event_id % 10 <> 3"), whole.where("event_id BETWEEN 25 AND 60 AND event_id > 39 OR event_id % 10 = 3 AND event_id < 40"),
        whole.where("event_id > 60"),
    ]
    lost = losing(monkeypatch, "_put", 1, f"/{table}")
    for k, part in enumerate(parts):
        arrive(part, folder)
        if k == 1:
            with pytest.raises(Exception, match="Lost"):
                run.activity_stream(stream(spark, folder), out, checkpoint)
        run.activity_stream(stream(spark, folder), out, checkpoint)
    late = brute_late([p.collect() for p in parts])
    assert lost and len(late) > 3
    assert sorted((r.batch, r.event_id) for r in run.late_activity(spark, out).collect()) == sorted(late)
    counts = {r.batch: (r.rows, r.late) for r in run.batch_counts(spark, out).collect()}
    assert counts == {b: (p.count(), sum(x == b for x, _ in late)) for b, p in enumerate(parts)}
    in_time = whole.where(~F.col("event_id").isin([i for _, i in late]))
    found = run.activity(spark, out)
    assert plain(found.drop("open")) == plain(monitor.endpoint_activity(fixtures.prediction_log_from(in_time)).select(*found.drop("open").columns))
    last = max(r.ts for r in whole.collect() if r.ts)
    assert all(r.open == (r.window_end > last - dt.timedelta(minutes=10)) for r in found.collect())
    assert found.where("open").count() > 0


def test_scoring_goes_on_after_a_loss(spark, paths):
    folder, out, checkpoint = paths
    whole = events(spark, 60)
    for k in range(4):
        arrive(whole.where(F.col("event_id") % 4 == k), folder)

    def scored(requests, fails):
        broken = F.when((F.col("event_id") % 4 == 2) & F.lit(fails), F.raise_error(F.lit("lost"))).otherwise(F.col("latency_s"))
        return requests.select("event_id", broken.alias("score"))

    with pytest.raises(StreamingQueryException):
        run.score_stream(stream(spark, folder), lambda d: scored(d, True), out, checkpoint)
    before = spark.read.parquet(out).count()
    assert 0 < before < 60
    found = run.score_stream(stream(spark, folder), lambda d: scored(d, False), out, checkpoint)
    assert sorted(r.event_id for r in found.collect()) == list(range(60))
    # Nothing new: nothing scored again. One more file: its rows only.
    assert run.score_stream(stream(spark, folder), lambda d: scored(d, True), out, checkpoint).count() == 60
    arrive(events(spark, 70).where("event_id >= 60 AND event_id % 4 <> 2"), folder)
    assert run.score_stream(stream(spark, folder), lambda d: scored(d, True), out, checkpoint).count() == 68
    with pytest.raises(ValueError, match="checkpoint"):
        run.score_stream(stream(spark, folder), lambda d: d, out)


def test_a_part_of_the_log_is_written_and_read_by_several_tasks(spark, sf, tmp_path):
    folder = str(tmp_path / "log")
    queries._arrive(spark, sf, folder, 0)
    assert len(list((tmp_path / "log").glob("*.parquet"))) > 1
