import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tripflow import fixtures, schema
from tripflow.operators import encode, gold, profile, score, silver, validate
from tripflow.plans import queries
from tripflow.sources import storage


def names(frame):
    return [r["dataset"].rsplit("/", 1)[1] for r in frame.collect()]


def test_inventory(spark, tmp_path):
    assert storage.file_inventory(spark, str(tmp_path / "nowhere")).count() == 0
    (tmp_path / "empty").mkdir()
    assert storage.file_inventory(spark, str(tmp_path / "empty")).count() == 0
    root = tmp_path / "bronze"
    for month in ("2025/april/trip_04", "2025/january/trip_01"):
        (root / month).parent.mkdir(parents=True)
        spark.range(5).toPandas().to_parquet(root / f"{month}.parquet")
    (root / "2025/january/notes.csv").write_text("x")
    (root / "2025/january/other.parquet").write_bytes((root / "2025/january/trip_01.parquet").read_bytes())
    spark.range(5).repartition(2).write.parquet(str(root / "2025/may/trip_05.parquet"))
    (root / "2025/june/trip_06.parquet").mkdir(parents=True)
    (root / "2025/june/trip_06.parquet/_SUCCESS").write_text("")
    found = storage.file_inventory(spark, str(root))
    assert names(found) == ["trip_04.parquet", "trip_01.parquet", "trip_05.parquet"]
    assert [r.files for r in found.collect()] == [1, 1, 2]
    assert names(storage.file_inventory(spark, str(root), "other*.parquet")) == ["other.parquet"]
    total = storage.inventory_total(found).first()
    assert total.datasets == 3 and total.files == 4 and total.bytes > 0


def test_scan_landed(spark, tmp_path):
    def month(value):
        return spark.createDataFrame([(1, value)], "VendorID int, trip_distance double").coalesce(1)

    month(1.0).toPandas().astype({"VendorID": "int32"}).to_parquet(tmp_path / "trip_01.parquet")
    month(2.0).write.parquet(str(tmp_path / "2025/may/trip_05.parquet"))
    month(3.0).write.parquet(str(tmp_path / "2025/may/other"))
    found = storage.scan_landed(spark, str(tmp_path))
    assert found.columns == schema.BRONZE.fieldNames()
    assert sorted((r.trip_distance, r.VendorID, r.fare_amount) for r in found.collect()) == [(1.0, 1, None), (2.0, 1, None)]


def test_scan_landed_with_differing_types(spark, tmp_path):
    pickup = dt.datetime(2025, 1, 2, 3)
    kinds = {
        "trip_01": ("RatecodeID bigint, passenger_count double, tpep_pickup_datetime timestamp_ntz", (1, 2.0, pickup)),
        "trip_02": ("RatecodeID int, passenger_count int, tpep_pickup_datetime timestamp", (2, 3, pickup)),
        "trip_03": ("RatecodeID double, passenger_count bigint, airport_fee float", (float("nan"), 4, 1.5)),
        "trip_04": ("RatecodeID bigint", (2**40,)),
    }
    for name, (kind, row) in kinds.items():
        spark.createDataFrame([row], kind).coalesce(1).write.parquet(str(tmp_path / "2025" / name) + ".parquet")
    found = storage.scan_landed(spark, str(tmp_path), with_source=True)
    assert found.columns == [*schema.BRONZE.names, storage.SOURCE]
    assert [f.dataType for f in found.schema][:-1] == [f.dataType for f in schema.BRONZE]
    rows = {r.source_file.rsplit("/", 1)[1]: (r.RatecodeID, r.passenger_count, r.tpep_pickup_datetime, r.Airport_fee) for r in found.collect()}
    assert rows == {
        "trip_01.parquet": (1, 2, pickup, None),
        "trip_02.parquet": (2, 3, pickup, None),
        "trip_03.parquet": (None, 4, None, 1.5),
        "trip_04.parquet": (None, None, None, None),
    }
    assert storage.scan_landed(spark, str(tmp_path / "nowhere")).collect() == []


def _landing(spark, *rows):
    pickups = [(s, p and dt.datetime(*p), i) for s, p, i in rows]
    return spark.createDataFrame(pickups, "source_file string, tpep_pickup_datetime timestamp_ntz, i int")


def test_landing_report(spark, tmp_path):
    path = str(tmp_path / "bronze")
    january = [("01", (2025, 1, d), d) for d in range(1, 11)] + [("01", None, 50)]
    report = storage.land_months(_landing(spark, *january), path).collect()
    assert {(r.source_file, r.year, r.month, r.rows, r.status) for r in report} == {
        ("01", 2025, 1, 10, "success"), ("01", None, None, 1, "success")}
    # February holds a stray of January, and an empty pickup of its own.
    february = [("02", (2025, 2, 1), 60), ("02", (2025, 1, 31), 61), ("02", None, 62)]
    report = storage.land_months(_landing(spark, *february), path).collect()
    assert {(r.source_file, r.year, r.month, r.rows, r.status) for r in report} == {
        ("02", 2025, 2, 1, "success"), ("02", 2025, 1, 1, "success"), ("02", None, None, 1, "success")}
    assert sorted(r.i for r in storage.scan_layer(spark, path).collect()) == [*range(1, 11), 50, 60, 61, 62]
    # Landing a file again replaces its rows, also of months it no longer has.
    storage.land_months(_landing(spark, ("02", (2025, 2, 2), 70)), path)
    assert sorted(r.i for r in storage.scan_layer(spark, path).collect()) == [*range(1, 11), 50, 70]


def _lowest_aggregate(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan[plan.rindex("Aggregate"):]


def test_landing_takes_paths_apart_once_a_file(spark, tmp_path, monkeypatch):
    seen, kept = {}, storage.written
    monkeypatch.setattr(storage, "written", lambda df, name: (seen.update({name: df}), kept(df, name))[1])
    storage.land_months(_landing(spark, ("01", (2025, 1, 5), 1)), str(tmp_path / "bronze"))
    assert "regexp_" not in _lowest_aggregate(seen["landing"])


def test_validate_columns(spark, tmp_path):
    good = spark.createDataFrame([], schema.BRONZE)
    good.coalesce(1).write.parquet(str(tmp_path / "good"))
    good.withColumnRenamed("fare_amount", "Fare_amount").drop("VendorID").coalesce(1).write.parquet(str(tmp_path / "bad"))
    report = validate.validate_columns(storage.list_files(spark, str(tmp_path)))
    rows = {("good" if "/good/" in r.path else "bad"): list(r.missing) for r in report.collect()}
    assert rows == {"good": [], "bad": ["VendorID", "fare_amount"]}
    with pytest.raises(ValueError, match="VendorID"):
        validate.require_columns(report)
    with pytest.raises(ValueError, match="No parquet files"):
        validate.require_columns(validate.validate_columns(storage.list_files(spark, str(tmp_path / "none"))))


def test_validate_counts(spark, sf):
    lines = fixtures.table(spark, sf, "lineitem")
    row = validate.validate_counts(lines, max_rows=10).first()
    assert row.rows == lines.count() and not row.within_budget


def test_counting_takes_paths_apart_once_a_file(spark, sf):
    assert "regexp_" not in _lowest_aggregate(validate.validate_counts(fixtures.table(spark, sf, "lineitem")))


def test_files_of_one_name_are_counted_apart(spark, tmp_path):
    for year, rows in ((2023, 10), (2024, 7)):
        spark.range(rows).coalesce(1).write.parquet(str(tmp_path / f"w{year}"))
        target = tmp_path / "in" / str(year) / "january"
        target.mkdir(parents=True)
        (target / "trip_01.parquet").write_bytes(next((tmp_path / f"w{year}").glob("part-*.parquet")).read_bytes())
    found = validate.validate_counts(spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))).collect()
    assert sorted((r.file_name, r.rows) for r in found) == [("trip_01.parquet", 7), ("trip_01.parquet", 10)]


def test_part_files_are_one_dataset(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "id % 2 AS p").repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    spark.range(8).selectExpr("id AS a", "id % 2 AS p").write.partitionBy("p").parquet(str(tmp_path / "parted.parquet"))
    (tmp_path / "mixed.parquet").mkdir()
    spark.range(5).selectExpr("id AS a").toPandas().to_parquet(tmp_path / "mixed.parquet/part-0.parquet")
    spark.range(5).selectExpr("id AS b").toPandas().to_parquet(tmp_path / "mixed.parquet/part-1.parquet")
    report = validate.validate_columns(storage.list_files(spark, str(tmp_path)), ["a", "b"])
    rows = sorted((r.path.rsplit("/", 1)[1], list(r.missing), r.status) for r in report.collect())
    # One part lacks the one column, the other the other.
    assert rows == [(f"{n}.parquet", m, "failed") for n, m in (("many", ["b"]), ("mixed", ["a", "b"]), ("parted", ["b"]))]
    for name, count in (("many", 10), ("parted", 8)):
        found = validate.validate_counts(spark.read.parquet(str(tmp_path / f"{name}.parquet")), max_rows=9).collect()
        assert [(r.file_name, r.rows, r.within_budget) for r in found] == [(f"{name}.parquet", count, count <= 9)]
    assert names(storage.file_inventory(spark, str(tmp_path), "m*.parquet")) == ["many.parquet", "mixed.parquet"]


def test_content_hash_sees_where_nulls_are(spark):
    from tripflow.operators import profile

    tables = [spark.createDataFrame([row], "a int, b int") for row in ((None, 5), (5, None))]
    assert len({profile.content_fingerprint(t).first().content_hash for t in tables}) == 2


def test_prediction_has_a_row_per_request(spark):
    from pyspark.sql import functions as F

    from tripflow import schema
    from tripflow.operators import models, score

    features = spark.range(4).select(
        "id", *[F.when((F.col("id") == 2) & (F.lit(i) == 3), None).otherwise(F.col("id") + i + 0.5).alias(n)
                for i, n in enumerate(schema.FEATURES)]
    )
    train = models.assemble(features.where("id <> 2").withColumn(schema.TARGET, F.col("id") * 2.0))
    model = models.fit("decision_tree", {"max_depth": 2}, train)
    found = {r.id: r.predicted_duration_minutes for r in score.predict(model, features, ["id"]).collect()}
    assert set(found) == {0, 1, 2, 3} and found[2] is None and found[1] is not None


def test_refresh_processes_only_pending_months(spark, tmp_path):
    base, ledger, out = (str(tmp_path / n) for n in ("bronze", "ledger", "silver"))

    def months(*values):
        return spark.createDataFrame([(dt.datetime(2025, m, 2), i) for m, i in values], "tpep_pickup_datetime timestamp_ntz, i int")

    storage.write_layer(storage.with_month(months((1, 1), (2, 2))), base)
    first = storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, lambda d: d)
    assert {(r.month, r.rows, r.status) for r in first.collect()} == {(1, 1, "committed"), (2, 1, "committed")}
    # January gets a late row and March arrives; February is committed as it is.
    storage.write_layer(storage.with_month(months((1, 9), (1, 8), (3, 3))), base)
    second = storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, lambda d: d)
    assert {(r.month, r.rows) for r in second.collect()} == {(1, 2), (3, 1)}
    assert {(r.month, r.i) for r in storage.scan_layer(spark, out).collect()} == {(1, 8), (1, 9), (2, 2), (3, 3)}
    assert spark.read.parquet(ledger).count() == 3
    # January is as it first was: the ledger knows its latest state only.
    storage.write_layer(storage.with_month(months((1, 7))), base)
    third = storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, lambda d: d)
    assert [(r.month, r.rows) for r in third.collect()] == [(1, 1)]
    assert storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, lambda d: d).isEmpty()


def test_refresh_with_null_pickups(spark, tmp_path):
    base, ledger, out = (str(tmp_path / n) for n in ("bronze", "ledger", "silver"))
    rows = [(dt.datetime(2025, 1, 2), 1), (None, 2)]
    frame = spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz, i int")
    storage.write_layer(storage.with_month(frame), base)
    first = storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, lambda d: d)
    assert {(r.year, r.month, r.rows) for r in first.collect()} == {(2025, 1, 1), (None, None, 1)}
    assert {r.i for r in storage.scan_layer(spark, out).collect()} == {1, 2}
    assert storage.refresh_layer(storage.scan_layer(spark, base), ledger, out, lambda d: d).isEmpty()


def test_failed_ledger_rows_stay_pending(spark):
    source = spark.createDataFrame([(2025, 1, 5), (2025, 2, 5)], "year int, month int, rows long")
    ledger = spark.createDataFrame([(2025, 1, 5, "failed"), (2025, 2, 5, "committed")], schema.LEDGER)
    assert [r.month for r in storage.pending_partitions(source, ledger).collect()] == [1]


def test_caps_and_samples(spark):
    frame = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    assert {r.id for r in storage.cap_rows(frame, 3, ["k", "id"]).collect()} == {0, 7, 14}
    sample = {r.id for r in storage.sample_rows(frame, 0.2, ["id"]).collect()}
    assert sample == {r.id for r in storage.sample_rows(frame.repartition(9), 0.2, ["id"]).collect()}
    assert 140 < len(sample) < 260
    assert sample != {r.id for r in storage.sample_rows(frame, 0.2, ["id"], seed=1).collect()}
    for unsampled in (None, 0, 1, 1.5):
        assert storage.sample_rows(frame, unsampled, ["id"]).count() == 1000
    assert storage.feature_target_view(frame, "id").columns == ["k", "id"]
    with pytest.raises(ValueError, match="not found"):
        storage.feature_target_view(frame, "nope")


def test_spread_leaves_large_scans_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, cores + 1)
    assert storage.spread(wide) is wide
    assert storage.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores


# --- encoders ------------------------------------------------------------------------------


def test_onehot_and_target_encoding(spark):
    kind = "VendorID double, PULocationID int, trip_duration_min double"
    train = spark.createDataFrame([(2.0, 1, 10.0), (1.0, 1, 20.0), (6.0, 2, 60.0), (None, None, 30.0)], kind)
    levels = encode.fit_levels(train, ["VendorID"])
    assert levels == {"VendorID": [2, 6]}
    fresh = spark.createDataFrame([(2.0, 1, 0.0), (9.0, 3, 0.0), (None, None, 0.0)], kind)
    flags = encode.encode_onehot(fresh, levels)
    assert flags.columns[-2:] == ["VendorID_2", "VendorID_6"] and "VendorID" not in flags.columns
    assert [(r.VendorID_2, r.VendorID_6) for r in flags.collect()] == [(1, 0), (0, 0), (0, 0)]
    means = storage.written(encode.target_means(train, ["PULocationID"]), "means")
    encoded = encode.encode_target(fresh, means, ["PULocationID"])
    assert sorted(r.PULocationID_encoded for r in encoded.collect()) == [15.0, 30.0, 30.0]


def test_levels_have_no_cap(spark):
    assert encode.fit_levels(spark.range(1002), ["id"]) == {"id": list(range(1, 1002))}


def test_scaling(spark):
    frame = spark.createDataFrame([(1.0, 4.0, None), (3.0, 4.0, None)], "a double, constant double, empty double")
    stats = encode.fit_scaling(frame, ["a", "constant", "empty", "absent"])
    assert stats["constant"] == (4.0, 1.0) and stats["empty"] == (0.0, 1.0) and "absent" not in stats
    rows = encode.scale_features(frame, stats).collect()
    assert [r.constant for r in rows] == [0.0, 0.0]
    assert rows[0].a == pytest.approx(-rows[1].a)


def test_state_survives_storage(spark, sf):
    table = queries._split_gold(spark, sf)
    encoded, encoders = encode.model_table(table)
    path = storage.shared_path(spark, "model-table")
    encode.save_model_table(encoded, encoders, path)
    assert {r.split for r in spark.read.parquet(f"{path}/splits").select("split").distinct().collect()} == {"train", "test", "val"}
    stored = encode.load_encoders(spark, path)
    assert stored.levels == encoders.levels and stored.scaling == encoders.scaling
    again = encode.apply_encoders(encode.drop_leakage(table), stored)
    columns = sorted(encoded.columns)
    assert again.select(columns).exceptAll(encoded.select(columns)).isEmpty()


def test_state_keeps_columns_of_one_level(spark):
    train = spark.createDataFrame([(1, 5, 2.0), (1, 6, 4.0)], "payment_type int, zone long, trip_duration_min double")
    means = encode.target_means(train, ["zone"])
    fitted = encode.Encoders(encode.fit_levels(train, ["payment_type"]), {}, means, ["zone"])
    stored = encode.Encoders.from_rows(fitted.as_rows())
    assert stored.levels == {"payment_type": []} and stored.target_columns == ["zone"]
    assert encode.apply_encoders(train, stored).columns == ["trip_duration_min", "zone_encoded"]


# --- profile -------------------------------------------------------------------------------


def test_profile_counts_nan_apart(spark):
    frame = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (3.0, "b"), (None, "c")], "x double, s string")
    rows = {r["column"]: r for r in profile.profile_columns(frame).collect()}
    assert (rows["x"].nulls, rows["x"].nans, rows["x"].min, rows["x"].max, rows["x"].mean) == (1, 1, 1.0, 3.0, 2.0)
    assert (rows["s"].nulls, rows["s"].mean) == (1, None)
    assert profile.schema_fingerprint(frame) != profile.schema_fingerprint(frame.select("s", "x"))
    one, two = (profile.content_fingerprint(f).first() for f in (frame, frame.repartition(3)))
    assert one == two


def test_stage_records(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run_id, status in (("20250101", "success"), ("20250102", "failed")):
        record = profile.stage_record(spark, "silver", run_id, run_id, f"{run_id}T00:00:00", status, data_rows={"in": 5}, error=None)
        profile.append_stage_record(record, path)
    row = profile.latest_stage_run(spark.read.schema(schema.STAGE_RUNS).parquet(path), ["run_id"]).first()
    assert (row.stage, row.run_id, row.status, row.data_rows) == ("silver", "20250102", "failed", {"in": "5"})


# --- scoring -------------------------------------------------------------------------------

REQUEST = {"pickup_datetime": "2025-01-15T08:30:00", "PULocationID": 161, "DOLocationID": 237, "trip_distance": 2.5}


def validated(spark, *requests):
    return score.validate_requests(spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(requests)], "i int, value string"))


def test_request_defaults(spark):
    row = validated(spark, REQUEST).first()
    assert row.broken_rules == [] and row.pickup_datetime == dt.datetime(2025, 1, 15, 8, 30)
    assert (row.passenger_count, row.VendorID, row.RatecodeID, row.payment_type, row.store_and_fwd_flag) == (1, 1, 1, 1, "N")
    assert (row.tolls_amount, row.Airport_fee, row.congestion_surcharge) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize(
    "change, broken",
    [({"trip_distance": -0.1}, ["trip_distance"]), ({"trip_distance": 0}, []), ({"passenger_count": 9}, []),
     ({"passenger_count": 10}, ["passenger_count"]), ({"passenger_count": -1}, ["passenger_count"]),
     ({"tolls_amount": -1}, ["tolls_amount"]), ({"Airport_fee": -1}, ["Airport_fee"]),
     ({"congestion_surcharge": -1}, ["congestion_surcharge"]), ({"PULocationID": None}, ["PULocationID"]),
     ({"pickup_datetime": "soon"}, ["pickup_datetime"]), ({"VendorID": "abc"}, ["VendorID"]),
     ({"trip_distance": "NaN"}, ["trip_distance"])],
)
def test_request_rules(spark, change, broken):
    assert validated(spark, {**REQUEST, **change}).first().broken_rules == broken


def test_unreadable_request_is_quarantined(spark):
    frame = score.validate_requests(spark.createDataFrame([("{oops",), (json.dumps(REQUEST),)], "value string"))
    assert score.accepted(frame).count() == 1
    assert set(score.quarantined(frame).first().broken_rules) >= {"pickup_datetime", "PULocationID", "trip_distance"}


def test_default_state_features(spark):
    row = score.model_features(score.accepted(validated(spark, {**REQUEST, "RatecodeID": 2, "payment_type": 2}))).first()
    assert row.asDict().keys() == dict.fromkeys(schema.FEATURES).keys()
    assert (row.pickup_zone_trip_count, row.dropoff_zone_trip_count, row.route_trip_count) == (0.0, 0.0, 0.0)
    assert row.PULocationID_encoded == row.DOLocationID_encoded == 16.975
    assert (row.RatecodeID_2, row.RatecodeID_3, row.payment_type_2, row.VendorID_2) == (1, 0, 1, 0)
    assert row.trip_distance == (2.5 - 3.557) / 3.868
    assert (row.pickup_hour, row.pickup_day_of_week, row.is_peak_hour, row.is_same_zone) == (8, 2, 1, 0)


def test_requests_and_gold_agree(spark, sf):
    """A trip through gold and the same trip through the request path give the same features."""
    trips = silver.clean(fixtures.trips(spark, sf, with_key=True), keep=fixtures.TRIP_KEY)
    shared = [c for c in schema.FEATURES if c.startswith(("pickup_", "is_", "sin_", "cos_", "log_", "sqrt_", "has_")) and "count" not in c]
    by_gold = gold.fare_features(gold.route_features(gold.distance_features(gold.time_features(trips))))
    by_request = score.request_features(trips.withColumnRenamed(schema.PICKUP, score.PICKUP))
    as_int = [F.col(c).cast("double").alias(c) for c in shared]
    left, right = (f.select(*fixtures.TRIP_KEY, *as_int) for f in (by_gold, by_request))
    assert left.count() > 1000 and left.exceptAll(right).isEmpty()


def test_lookup_counts_fall_back_to_the_mean(spark, sf):
    table = queries._split_gold(spark, sf)
    train = table.where("split = 'train'")
    _, encoders = encode.model_table(table)
    lookups = score.fit_lookups(train)
    zone = train.select("PULocationID").first()[0]
    known, unseen = {**REQUEST, "PULocationID": zone}, {**REQUEST, "PULocationID": 10**6}
    rows = score.model_features(score.accepted(validated(spark, known, unseen)), encoders, lookups, keep=["i"]).orderBy("i").collect()
    own = train.where(F.col("PULocationID") == zone).agg(F.avg(schema.TARGET)).first()[0]
    overall = train.agg(F.avg(schema.TARGET)).first()[0]
    assert rows[0].PULocationID_encoded == pytest.approx(own) and rows[1].PULocationID_encoded == pytest.approx(overall)
    assert rows[0].pickup_zone_trip_count != 0.0 and rows[1].pickup_zone_trip_count == 0.0


def test_prediction_is_clipped_and_rounded(spark):
    from pyspark.ml.regression import LinearRegression

    features = score.model_features(score.accepted(validated(spark, REQUEST, {**REQUEST, "trip_distance": 50})), keep=["i"])
    from tripflow.operators.models import assemble

    rows = assemble(features).withColumn("label", F.when(F.col("i") == 0, -5.0).otherwise(12.3456))
    model = LinearRegression(maxIter=20).fit(rows)
    found = {r.i: r.predicted_duration_minutes for r in score.predict(model, features, ["i"]).collect()}
    assert found[0] == 0.0 and found[1] == pytest.approx(12.35, abs=0.02)


# --- shared folder -------------------------------------------------------------------------


class NoFolderSession:
    """Stands in for a session without ``spark.checkpoint.dir``."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master, self.folder = master, None

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(NoFolderSession("yarn"))
    alone = NoFolderSession("local[4]")
    assert storage.shared_folder(alone) == storage.shared_folder(alone) == alone.folder


def test_scoring_compiles(spark, sf):
    """No generated method of scoring is longer than the JVM compiles, and rules are no part of an interpreted filter."""
    from tripflow.plans import queries

    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scored = queries.score_batch(spark, sf)
        generated = scored._jdf.queryExecution().debug().codegenToSeq()
        sizes = [generated.apply(i)._3().maxMethodCodeSize() for i in range(generated.length())]
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", limit)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) <= 8000
    assert "lambda" not in scored._jdf.queryExecution().executedPlan().toString()
