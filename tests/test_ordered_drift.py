import math
import random

import pytest
from pyspark.sql import functions as F

from tripflow import fixtures
from tripflow.functions.significance import chi_square_sf, kolmogorov_sf, two_sided_normal_p
from tripflow.operators import drift, ordered, split
from tripflow.sources.storage import written


def test_ranges_grow_with_the_distinct_values(spark):
    counts = [ordered.range_count(n, 100) for n in (0, 1, 100, 101, 200, 201, 800, 100 * 5000)]
    assert counts == [1, 1, 1, 2, 2, 4, 8, 8192]
    used = {}
    for n in (50, 400, 3200):
        frame = written(spark.range(n).select(F.lit("g").alias("g"), (F.col("id") * 3 - 7).alias("v"), F.lit(1).alias("n")), "t")
        edges, count = ordered.range_edges(frame, "g", "v", 100)
        ranged = ordered._with_range(frame.join(edges, "g"), "v", "_edges", count).groupBy("_range").count().collect()
        used[n] = len(ranged)
        assert count == ordered.range_count(n, 100) and max(r["count"] for r in ranged) <= 200
    assert used == {50: 1, 400: 4, 3200: 32}


@pytest.mark.parametrize("range_values", [40, 700, ordered.RANGE_VALUES])
def test_running_counts_against_brute_force(spark, range_values):
    source = random.Random(7)
    # A third of all rows share one value; the tail is long; negatives and tiny gaps are in.
    values = {"a": {5.0: 4000}, "b": {0.0: 1}}
    for _ in range(3000):
        values["a"][source.choice([source.gauss(0, 1), source.expovariate(0.001), 1e12 * source.random()])] = source.randint(1, 5)
    rows = [(g, v, n, n % 3) for g, per in values.items() for v, n in per.items()]
    frame = written(spark.createDataFrame(rows, "g string, v double, n long, m long"), "t")
    found = {(r.g, r.v): r for r in ordered.running_counts(frame, "g", "v", ["n", "m"], range_values).collect()}
    assert len(found) == len(rows)
    for group in values:
        n = m = 0
        mine = sorted((r for r in rows if r[0] == group), key=lambda r: r[1])
        for i, (_, v, dn, dm) in enumerate(mine):
            n, m = n + dn, m + dm
            row = found[group, v]
            assert (row.running_n, row.running_m) == (n, m)
            assert row.next_value == (mine[i + 1][1] if i + 1 < len(mine) else None)
        assert {found[group, r[1]].total_n for r in mine} == {n}


@pytest.mark.parametrize("size", [1, 2, 10, 999])
def test_exact_quantiles(spark, size):
    source = random.Random(size)
    values = sorted(source.choice([7, source.randint(0, 500)]) for _ in range(size))
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    row = ordered.exact_quantiles(frame, F.col("v"), {"p70": 0.70, "p85": 0.85, "p100": 1.0}).first()
    expected = [values[math.ceil(p * size) - 1] for p in (0.70, 0.85, 1.0)]
    assert list(row) == expected


def test_split_names_and_ties(spark):
    frame = spark.range(100).select(
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("tpep_pickup_datetime"), "id"
    )
    labels = {r["id"]: r["split"] for r in split.time_split(frame).collect()}
    # The middle part is test and the tail is val.
    assert [labels[i] for i in (0, 69, 70, 84, 85, 99)] == ["train", "train", "test", "test", "val", "val"]
    same = frame.withColumn("tpep_pickup_datetime", F.lit("2025-01-01").cast("timestamp_ntz"))
    assert {r["split"] for r in split.time_split(same).collect()} == {"train"}


def test_random_split_is_stable(spark):
    frame = spark.range(2000)
    first = {tuple(r) for r in split.random_split(frame, ["id"]).collect()}
    again = {tuple(r) for r in split.random_split(frame.repartition(13), ["id"]).collect()}
    assert first == again
    assert 0.75 < sum(1 for _, s in first if s == "train") / 2000 < 0.85


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "x, df, p",
    # Published critical values of the χ² distribution.
    [(3.841459, 1, 0.05), (6.634897, 1, 0.01), (5.991465, 2, 0.05), (18.307038, 10, 0.05), (124.342113, 100, 0.05),
     (29.588298, 10, 0.001)],
)
def test_chi_square_tail(spark, x, df, p):
    assert value(spark, chi_square_sf(F.lit(x), F.lit(df))) == pytest.approx(p, rel=1e-5)


def test_tails_at_the_ends(spark):
    assert value(spark, chi_square_sf(F.lit(0.0), F.lit(3))) == 1.0
    assert value(spark, chi_square_sf(F.lit(1e7), F.lit(3))) == 0.0
    assert value(spark, chi_square_sf(F.lit(50000.0), F.lit(50000))) == pytest.approx(0.5, abs=0.01)
    assert value(spark, chi_square_sf(F.lit(None).cast("double"), F.lit(3))) is None
    assert value(spark, two_sided_normal_p(F.lit(1.959964))) == pytest.approx(0.05, rel=1e-5)
    # The scaled distances 1.3581 and 1.6276 have tails 5 % and 1 %.
    for scaled, p in ((1.3581, 0.05), (1.6276, 0.01)):
        d = F.lit(scaled / math.sqrt(500.0))
        assert value(spark, kolmogorov_sf(d, F.lit(1000), F.lit(1000))) == pytest.approx(p, rel=1e-3)


def test_known_statistics_on_trips(spark):
    trips = fixtures.trips(spark, "/root/testdata/sf0.01").withColumn("is_reference", F.year("tpep_pickup_datetime") <= 1998)
    frequencies = drift.column_frequencies(trips, ["fare_amount", "trip_distance"], ["payment_type", "RatecodeID"])
    ordered_rows = {r["column"]: r for r in drift.ordered_statistics(frequencies).collect()}
    assert (round(ordered_rows["fare_amount"].ks, 6), round(ordered_rows["fare_amount"].w1, 6)) == (0.006239, 1.189161)
    assert (round(ordered_rows["trip_distance"].ks, 6), round(ordered_rows["trip_distance"].w1, 6)) == (0.003895, 0.086253)
    shares = {r["column"]: r for r in drift.share_statistics(frequencies).collect()}
    assert (round(shares["payment_type"].js, 6), round(shares["payment_type"].chi2, 6)) == (0.023823, 107.320034)
    assert (round(shares["RatecodeID"].js, 6), round(shares["RatecodeID"].chi2, 6)) == (0.003158, 1.764678)
    # The same column drifts by p-value and not by distance: kind and threshold go with the method.
    by_distance = {r["column"]: r for r in drift.drift_columns(frequencies).collect()}
    by_p = {r["column"]: r for r in drift.drift_columns(frequencies, small_reference_rows=10**9).collect()}
    assert (by_distance["payment_type"].score_kind, by_distance["payment_type"].drifted) == ("distance", False)
    assert (by_p["payment_type"].method, by_p["payment_type"].drifted) == ("chi2", True)
    assert by_p["fare_amount"].method == "ks" and not by_p["fare_amount"].drifted


def test_new_category_and_empty_side(spark):
    rows = [("x", True)] * 50 + [("y", True)] * 50 + [("x", False)] * 50 + [("z", False)] * 50
    frame = spark.createDataFrame(rows, "c string, is_reference boolean")
    row = drift.share_statistics(drift.column_frequencies(frame, [], ["c"])).first()
    assert (row.new_share, row.chi2_p) == (0.5, 0.0)
    only_reference = drift.column_frequencies(frame.where("is_reference"), [], ["c"])
    row = drift.drift_columns(only_reference).first()
    assert (row.method, row.score, row.emptied, row.drifted) == ("missing", None, True, True)


def test_values_are_counted_without_an_array_per_row(spark, monkeypatch):
    monkeypatch.setattr(drift, "written", lambda df, name: df)
    kind = "is_reference boolean, a double, `b c` long, d string, e boolean, f tinyint"
    rows = [(True, 1.5, 2**53 + 1, "x", True, 7), (False, 1.5, 2**53, None, None, 7), (None, float("inf"), None, "2", False, None)]
    found = drift.column_frequencies(spark.createDataFrame(rows, kind), ["a", "f"], ["b c", "d", "e"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan and "inline" not in plan
    big = str(2**53)
    expected = [
        ("a", 1.5, None, 1, 1), ("a", None, None, 0, 0), ("f", 7.0, None, 1, 1), ("f", None, None, 0, 0),
        ("b c", None, big, 0, 1), ("b c", None, str(2**53 + 1), 1, 0), ("b c", None, None, 0, 0),
        ("d", None, "x", 1, 0), ("d", None, "2", 0, 0), ("d", None, None, 0, 1),
        ("e", None, "true", 1, 0), ("e", None, "false", 0, 0), ("e", None, None, 0, 1),
    ]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_emptied_columns_fail_the_gate(spark):
    kind = "is_reference boolean, a double, b string, c double, d double"
    rows = [(True, float(i), "x", None, 1.0 * (i % 3)) for i in range(60)]
    rows += [(False, None if i % 2 else float("nan"), "x", None, 1.0 * (i % 3)) for i in range(60)]
    found = drift.drift_columns(drift.column_frequencies(spark.createDataFrame(rows, kind), ["a", "c", "d"], ["b"]))
    by_name = {r["column"]: r for r in found.collect()}
    assert (by_name["a"].drifted, by_name["a"].emptied, by_name["a"].cur_missing, by_name["a"].ref_rows) == (True, True, 60, 60)
    assert (by_name["c"].drifted, by_name["c"].method, by_name["c"].ref_missing) == (False, "missing", 60)
    assert not by_name["b"].drifted and not by_name["d"].drifted
    summary = drift.drift_summary(found, "a")
    row = drift.drift_gate(summary).first()
    assert (row.n_columns, row.n_drifted, row.emptied_columns, row.passed) == (4, 1, ["a"], False)
    assert row.violations == ["values on one side only: a"]
    # Requested columns are there without any row.
    nothing = drift.drift_columns(drift.column_frequencies(spark.createDataFrame([], kind), ["a"], ["b"]))
    assert {(r["column"], r.drifted) for r in nothing.collect()} == {("a", False), ("b", False)}


def test_chi_square_of_many_degrees(spark):
    from tripflow.functions.significance import chi_square_sf

    rows = [(9_999.0, 10_000), (10_200.0, 10_000), (10_200.0, 10_001), (9_900.0, 10_001), (3e9, 3_000_000_000), (0.0, 20_000)]
    frame = spark.createDataFrame(rows, "x double, k long").select("*", chi_square_sf(F.col("x"), F.col("k")).alias("p"))
    found = {(r.x, r.k): r.p for r in frame.collect()}
    assert found[10_200.0, 10_000] == pytest.approx(found[10_200.0, 10_001], abs=3e-3)
    assert found[3e9, 3_000_000_000] == pytest.approx(0.5, abs=1e-4)
    assert found[0.0, 20_000] == 1.0 and 0.75 < found[9_900.0, 10_001] < 0.77


def test_z_test(spark):
    rows = [("N", True)] * 60 + [("Y", True)] * 40 + [("N", False)] * 90 + [("Y", False)] * 10
    frame = spark.createDataFrame(rows, "c string, is_reference boolean")
    row = drift.share_statistics(drift.column_frequencies(frame, [], ["c"])).first()
    assert row.z == pytest.approx((0.4 - 0.1) / math.sqrt(0.25 * 0.75 * 0.02))
    assert row.z_p == pytest.approx(math.erfc(row.z / math.sqrt(2)), rel=1e-6)


@pytest.mark.parametrize(
    "share, score, kind, violations",
    [(0.1, 0.5, "pvalue", 0), (0.3, 0.05, "pvalue", 0), (0.5, 0.5, "pvalue", 1), (0.1, 0.01, "pvalue", 1),
     (0.1, None, "pvalue", 0), (0.5, 0.01, "pvalue", 2), (0.1, 0.01, "distance", 0), (0.1, 0.2, "distance", 1)],
)
def test_drift_gate(spark, share, score, kind, violations):
    columns = "share_drifted double, target_score double, target_score_kind string, emptied_columns array<string>"
    summary = spark.createDataFrame([(share, score, kind, [])], columns)
    row = drift.drift_gate(summary).first()
    assert len(row.violations) == violations
    assert row.passed == (violations == 0) and row.retrain == (violations > 0)


def test_exact_quantiles_count_only_values_near_them(spark, monkeypatch):
    kept, write = {}, ordered.written

    def noted(df, name):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(ordered, "written", noted)
    frame = spark.range(200_000).select(((F.col("id") * 7919) % 200_003).alias("v"))
    values = sorted((i * 7919) % 200_003 for i in range(200_000))
    row = ordered.exact_quantiles(frame, F.col("v"), {"p0": 0.0001, "p70": 0.70, "p85": 0.85}).first()
    assert list(row) == [values[math.ceil(p * 200_000) - 1] for p in (0.0001, 0.70, 0.85)]
    assert kept["frequencies"].count() < 10_000


def test_exact_quantiles_do_not_trust_the_sketch(spark, monkeypatch):
    wrong = {"p70": (700.0, 100.0, 200.0), "p85": (850.0, 840.0, 860.0)}
    monkeypatch.setattr(ordered, "_brackets", lambda values, probabilities: (1000, wrong))
    row = ordered.exact_quantiles(spark.range(1000), F.col("id"), {"p70": 0.70, "p85": 0.85}).first()
    assert list(row) == [699, 849]
    monkeypatch.undo()
    assert list(ordered.exact_quantiles(spark.range(0), F.col("id"), {"p70": 0.70}).first()) == [None]
