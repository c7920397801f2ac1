import datetime as dt
import shutil

import pytest
from conftest import formatted_plan
from pyspark.sql import functions as F

from tripflow.sources import records, storage

KIND = "tpep_pickup_datetime timestamp_ntz, i int"


def write(spark, path, *rows, mode="overwrite"):
    frame = spark.createDataFrame([(m and dt.datetime(2025, m, 2), i) for m, i in rows], KIND).coalesce(1)
    storage.write_layer(storage.with_month(frame), path, mode=mode)


def rows(spark, path):
    return sorted((r.month or 0, r.i) for r in storage.scan_layer(spark, path).collect())


@pytest.fixture
def paths(tmp_path):
    return [str(tmp_path / n) for n in ("bronze", "ledger", "silver")]


def refresh(spark, paths, transform=lambda d: d, **more):
    base, ledger, out = paths
    found = storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, transform, **more).collect()
    return {(r.month, r.rows, r.status, r.version) for r in found}


def test_replaced_content_with_as_many_rows(spark, paths):
    write(spark, paths[0], (1, 1), (1, 2), (2, 3))
    assert refresh(spark, paths) == {(1, 2, "committed", 1), (2, 1, "committed", 1)}
    write(spark, paths[0], (1, 10), (1, 20))
    assert refresh(spark, paths) == {(1, 2, "committed", 2)}
    assert rows(spark, paths[2]) == [(1, 10), (1, 20), (2, 3)]


def test_month_whose_rows_are_all_rejected(spark, paths):
    write(spark, paths[0], (1, 1), (1, 2), (2, 3), (None, 4))
    refresh(spark, paths)
    write(spark, paths[0], (1, -1), (1, -2), (1, -3), (None, -4))
    assert refresh(spark, paths, lambda d: d.where("i > 0")) == {(1, 3, "committed", 2), (None, 1, "committed", 2)}
    assert rows(spark, paths[2]) == [(2, 3)]
    assert refresh(spark, paths, lambda d: d.where("i > 0")) == set()


def test_month_that_is_gone(spark, paths):
    write(spark, paths[0], (1, 1), (2, 2), (3, 3))
    refresh(spark, paths)
    shutil.rmtree(f"{paths[0]}/year=2025/month=2")
    assert refresh(spark, paths, complete=False) == set() and (2, 2) in rows(spark, paths[2])
    assert refresh(spark, paths) == {(2, 0, "removed", 2)}
    assert rows(spark, paths[2]) == [(1, 1), (3, 3)]
    assert refresh(spark, paths) == set()
    write(spark, paths[0], (2, 2))
    assert refresh(spark, paths) == {(2, 1, "committed", 3)}
    assert rows(spark, paths[2]) == [(1, 1), (2, 2), (3, 3)]


def test_rewritten_month_of_the_same_content_is_not_processed(spark, paths):
    write(spark, paths[0], (1, 1), (1, 2), (2, 3))
    refresh(spark, paths)
    write(spark, paths[0], (1, 2), (1, 1))
    seen = []

    def transform(d):
        seen.append(d)
        return d

    assert refresh(spark, paths, transform) == set() and not seen
    # Its new files are noted: the digest is not computed again.
    ledger = spark.read.parquet(paths[1])
    now = storage.month_files(storage.scan_layer(spark, paths[0]))
    assert storage.pending_partitions(now, ledger, ("files",)).isEmpty()


def test_failed_transform_leaves_months_pending(spark, paths):
    write(spark, paths[0], (1, 1), (2, 2))
    refresh(spark, paths)
    write(spark, paths[0], (1, 5))

    def fails(d):
        return d.withColumn("i", F.raise_error(F.lit("no such month")).cast("int"))

    with pytest.raises(Exception, match="no such month"):
        refresh(spark, paths, fails)
    assert rows(spark, paths[2]) == [(1, 1), (2, 2)]
    assert refresh(spark, paths) == {(1, 1, "committed", 2)}


def test_source_that_is_no_plain_scan(spark, paths):
    write(spark, paths[0], (1, 1), (1, 2), (2, 3))
    base, ledger, out = paths

    def again():
        scan = storage.scan_layer(spark, base)
        source = scan.unionByName(scan.where("false"))
        assert storage.month_files(source) is None
        return {(r.month, r.rows) for r in storage.refresh_layer(source, ledger, out, lambda d: d).collect()}

    assert again() == {(1, 2), (2, 1)} and again() == set()
    write(spark, base, (2, 30))
    assert again() == {(2, 1)} and rows(spark, out) == [(1, 1), (1, 2), (2, 30)]


def test_changed_filter_over_the_same_files(spark, paths):
    write(spark, paths[0], (1, 1), (1, 2), (2, 3))
    base, ledger, out = paths
    storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, lambda d: d)
    fewer = storage.scan_layer(spark, base).where("i <> 2")
    assert storage.refresh_layer(fewer, ledger, out, lambda d: d).isEmpty()
    assert storage.refresh_layer(fewer, ledger, out, lambda d: d, trust_files=False).count() == 1
    assert rows(spark, out) == [(1, 1), (2, 3)]


def test_digest_counts_repeats_and_places_of_nulls(spark):
    def digest(*values):
        frame = spark.createDataFrame(list(values), "year int, month int, a int, b int").repartition(3)
        return storage.month_digests(frame).first().digest

    assert digest((1, 1, 5, 6), (1, 1, 7, 8)) == digest((1, 1, 7, 8), (1, 1, 5, 6))
    different = [digest((1, 1, 5, None)), digest((1, 1, None, 5)), digest((1, 1, 5, None), (1, 1, 5, None)), digest((1, 1, 5, 5))]
    assert len(set(different)) == 4


def test_digest_is_the_exact_sum_of_hashes(spark):
    numbers = [2**63 - 1, 2**63 - 1, 2**63 - 1, -(2**63), -1, 0, 1, 2**44, -(2**44) - 1, 2**22 - 1, -(2**22)]
    frame = spark.createDataFrame([(n,) for n in numbers], "n long")
    total = frame.agg(storage._exact_sum(F.col("n")).cast("string").alias("s"))
    assert total.first().s == str(sum(numbers))
    source = spark.range(1000).select(F.lit(2025).alias("year"), (F.col("id") % 2).cast("int").alias("month"), "id")
    hashes = source.select("month", F.xxhash64("id", F.col("id").isNull()).alias("h")).collect()
    found = storage.month_digests(source)
    assert {r.month: int(r.digest) for r in found.collect()} == {m: sum(r.h for r in hashes if r.month == m) for m in (0, 1)}
    # No decimal a row: sums of longs only.
    assert "sum(cast(xxhash64" not in formatted_plan(found)


def landing(spark, *values):
    found = [(s, p and dt.datetime(*p), i) for s, p, i in values]
    return spark.createDataFrame(found, f"source_file string, {KIND}")


def report(frame):
    return {(r.source_file, r.month, r.rows, r.status) for r in frame.collect()}


def test_landing_does_not_read_other_sources(spark, tmp_path):
    path = str(tmp_path / "bronze")
    storage.land_months(landing(spark, ("a/1:x", (2025, 1, 1), 1), ("a/1:x", (2025, 1, 2), 2)), path)
    # What was landed before cannot be read any more; it is not needed either.
    old = next((tmp_path / "bronze").glob("source_file=*/part-*.parquet"))
    old.write_bytes(b"x" * old.stat().st_size)
    found = storage.land_months(landing(spark, ("b", (2025, 1, 1), 3), (None, None, 4)), path)
    assert report(found) == {("b", 1, 1, "success"), (None, None, 1, "success")}


def test_landing_reports_sources_whose_files_changed(spark, tmp_path):
    path = str(tmp_path / "bronze")
    storage.land_months(landing(spark, ("a", (2025, 1, 1), 1), ("b", (2025, 2, 2), 2)), path)
    next((tmp_path / "bronze").glob("source_file=a/part-*.parquet")).unlink()
    found = storage.land_months(landing(spark, ("c", (2025, 1, 1), 3)), path)
    assert report(found) == {("c", 1, 1, "success"), ("a", 1, -1, "failed")}
    # Landing it again mends that.
    assert report(storage.land_months(landing(spark, ("a", (2025, 1, 1), 1)), path)) == {("a", 1, 1, "success")}
    assert report(storage.land_months(landing(spark, ("a", (2025, 3, 1), 1)), path)) == {("a", 3, 1, "success")}


def test_landing_nothing(spark, tmp_path):
    path = str(tmp_path / "bronze")
    assert report(storage.land_months(landing(spark), path)) == set()


def test_stage_records_on_success_and_failure(spark, tmp_path, paths):
    log = str(tmp_path / "runs")
    run = records.Run(spark, log, "nightly", "7")
    storage.land_months(landing(spark, ("a", (2025, 1, 1), 1), ("b", (2025, 2, 2), 2)), str(tmp_path / "landed"), run=run)
    write(spark, paths[0], (1, 1), (1, 2), (2, 3))
    refresh(spark, paths, lambda d: d.where("i > 1"), run=run)
    with pytest.raises(ZeroDivisionError):
        write(spark, paths[0], (3, 3))
        refresh(spark, paths, lambda d: 1 / 0, run=run)
    found = sorted(spark.read.parquet(log).collect(), key=lambda r: r.created_at_utc)
    assert [(r.stage, r.status) for r in found] == [
        ("land_months", "success"), ("refresh_layer", "success"), ("refresh_layer", "failed")]
    assert {(r.pipeline_run_id, r.run_id) for r in found} == {("nightly", "7")}
    assert found[0].data_rows == {"written": "2", "found": "2"} and found[0].metrics["sources"] == "2"
    assert found[1].data_rows == {"written": "2", "read": "3"} and found[1].metrics["months"] == "2"
    assert found[1].error is None and found[2].error.startswith("ZeroDivisionError") and "duration_seconds" in found[2].metrics


def test_months_at_rest_are_not_read(spark, paths):
    write(spark, paths[0], (1, 1), (2, 2))
    source = storage.scan_layer(spark, paths[0])
    plan = formatted_plan(storage.month_files(source))
    assert "ReadSchema: struct<>" in plan
