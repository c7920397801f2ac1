"""Per-column drift between a reference and a current set of rows.

Every statistic derives from one frequency table (column, value, reference count, current
count): one pass over the data with map-side combine, after which a frequent value is one
row. The full data is compared, not a first slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.significance import chi_square_sf, kolmogorov_sf, two_sided_normal_p
from tripflow.operators.ordered import running_counts
from tripflow.sources.storage import written

# --- fixed values: test selection and thresholds ---
SMALL_REFERENCE_ROWS = 1000
FEW_VALUES = 5
P_VALUE_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
STDDEV_FLOOR = 0.001


def label_sides(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Both sides in one frame with ``is_reference``."""
    return reference.withColumn("is_reference", F.lit(True)).unionByName(
        current.withColumn("is_reference", F.lit(False))
    )


def column_frequencies(
    labelled: DataFrame, numeric: list[str], categorical: list[str], is_reference: str = "is_reference"
) -> DataFrame:
    """Rows (column, number, category, n_ref, n_cur), one per value, and one per column without either.

    The latter counts the null, NaN and infinite values; it is there for each requested column, also
    with counts of zero. Written to the shared folder: all statistics below read it, the data are
    scanned once.
    """
    names = [*numeric, *categorical]
    number = [F.col(c).cast("double") for c in numeric]
    finite = [F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n) for n in number]
    integers = {f.name for f in labelled.select(*categorical).schema if isinstance(f.dataType, T.IntegralType)}

    def text_or_code(name: str) -> Column:
        return F.col(name).cast("long" if name in integers else "string")

    wide = labelled.select(
        F.col(is_reference).cast("boolean").alias("_ref"),
        *[n.alias(f"_value{i}") for i, n in enumerate(finite)],
        *[text_or_code(c).alias(f"_value{i}") for i, c in enumerate(categorical, len(numeric))],
    )
    # A row of neither side, without values: each requested column is there.
    wide = wide.union(labelled.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType) for f in wide.schema]))
    wide = wide.select(
        "*", F.lit(None).cast("double").alias("_no_number"), F.lit(None).cast("string").alias("_no_text"),
        F.lit(None).cast("long").alias("_no_code"), *[F.lit(i).alias(f"_id{i}") for i in range(len(names))],
    )
    # UNPIVOT makes the rows without an array of structs for each trip; a number stands for the column's name in the keys, and
    # integer categories become text once a value, not once a row.
    slots = [("{}", "_no_text", "_no_code")] * len(numeric)
    slots += [("_no_number", "_no_text", "{}") if c in integers else ("_no_number", "{}", "_no_code") for c in categorical]
    turned = ", ".join(f"(_id{i}, {', '.join(slot).format(f'_value{i}')})" for i, slot in enumerate(slots))
    rows = labelled.sparkSession.sql(
        f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS ((_id, number, _text, _code) FOR _name IN ({turned}))", wide=wide
    )
    frequencies = (
        rows.groupBy("_id", "number", "_text", "_code")
        .agg(F.count_if(F.col("_ref")).alias("n_ref"), F.count_if(~F.col("_ref")).alias("n_cur"))
        .select(
            F.get(F.array(*map(F.lit, names)), F.col("_id")).alias("column"), "number",
            F.coalesce("_text", F.col("_code").cast("string")).alias("category"), "n_ref", "n_cur",
        )
    )
    return written(frequencies, "frequencies")


HAS_VALUE = "number IS NOT NULL OR category IS NOT NULL"


def missing_values(frequencies: DataFrame) -> DataFrame:
    """Per requested column: null, NaN and infinite values of both sides."""
    return frequencies.groupBy("column").agg(
        *[F.sum(F.when(F.expr(HAS_VALUE), 0).otherwise(F.col(f"n_{s}"))).alias(f"{s}_missing") for s in ("ref", "cur")]
    )


def _sides(frequencies: DataFrame) -> DataFrame:
    """Per column: rows of both sides, number of distinct values, whether it is numeric."""
    return frequencies.groupBy("column").agg(
        F.sum("n_ref").alias("ref_rows"),
        F.sum("n_cur").alias("cur_rows"),
        F.count("*").alias("n_values"),
        F.max(F.col("number").isNotNull()).alias("is_numeric"),
        F.try_divide(F.sum(F.col("n_ref") * F.col("number")), F.sum("n_ref")).alias("ref_mean"),
    )


def ordered_statistics(frequencies: DataFrame) -> DataFrame:
    """KS distance and Wasserstein-1 distance of every numeric column.

    ``wasserstein`` is divided by the reference's population stddev, with a floor.
    """
    numbers = frequencies.where("number IS NOT NULL").select("column", "number", "n_ref", "n_cur")
    running = running_counts(numbers, "column", "number", ["n_ref", "n_cur"])
    gap = F.abs(
        F.try_divide(F.col("running_n_ref").cast("double"), F.col("total_n_ref"))
        - F.try_divide(F.col("running_n_cur").cast("double"), F.col("total_n_cur"))
    )
    mean = numbers.groupBy("column").agg(
        F.try_divide(F.sum(F.col("n_ref") * F.col("number")), F.sum("n_ref")).alias("_mean")
    )
    deviation = F.col("n_ref") * F.pow(F.col("number") - F.col("_mean"), F.lit(2.0))
    per_column = (
        running.join(F.broadcast(mean), "column")  # one row per tested column
        .groupBy("column")
        .agg(
            F.max(gap).alias("ks"),
            F.coalesce(F.sum(gap * (F.col("next_value") - F.col("number"))), F.lit(0.0)).alias("_w1"),
            F.sqrt(F.try_divide(F.sum(deviation), F.sum("n_ref"))).alias("_stddev"),
            F.sum("n_ref").alias("_ref"),
            F.sum("n_cur").alias("_cur"),
        )
    )
    both = (F.col("_ref") > 0) & (F.col("_cur") > 0)
    return per_column.select(
        "column",
        "ks",
        kolmogorov_sf(F.col("ks"), F.col("_ref"), F.col("_cur")).alias("ks_p"),
        F.when(both, F.col("_w1")).alias("w1"),
        F.when(both, F.col("_w1") / F.greatest("_stddev", F.lit(STDDEV_FLOOR))).alias("wasserstein"),
    )


def share_statistics(frequencies: DataFrame) -> DataFrame:
    """Jensen–Shannon distance, χ² against reference shares, two-proportion z; per column.

    A category the reference never had makes χ² infinite: its p-value is 0 and its share of
    current rows is in ``new_share``; ``chi2`` sums over the known categories.
    """
    frequencies = frequencies.where(HAS_VALUE)
    sides = F.broadcast(_sides(frequencies))  # one row per tested column
    p = F.try_divide(F.col("n_ref").cast("double"), F.col("ref_rows"))
    q = F.try_divide(F.col("n_cur").cast("double"), F.col("cur_rows"))
    middle = (p + q) / 2.0

    def part(share: Column) -> Column:
        return F.when(share > 0, share * F.log(share / middle)).otherwise(0.0)

    expected = p * F.col("cur_rows")
    squared = F.pow(F.col("n_cur") - expected, F.lit(2.0))
    labelled = frequencies.join(sides, "column")
    stats = labelled.groupBy("column", "ref_rows", "cur_rows", "n_values", "is_numeric").agg(
        (F.sum(part(p) + part(q)) / 2.0).alias("_js2"),
        F.sum(F.when(p > 0, F.try_divide(squared, expected)).otherwise(0.0)).alias("chi2"),
        F.sum(F.when(p > 0, 0.0).otherwise(q)).alias("new_share"),
    )
    both = (F.col("ref_rows") > 0) & (F.col("cur_rows") > 0)
    chi2_p = F.when(F.col("new_share") > 0, 0.0).otherwise(chi_square_sf(F.col("chi2"), F.col("n_values") - 1))
    return stats.join(F.broadcast(_proportion_z(labelled)), "column", "left").select(
        "column",
        "ref_rows",
        "cur_rows",
        "n_values",
        "is_numeric",
        F.when(both, F.sqrt(F.greatest(F.col("_js2"), F.lit(0.0)))).alias("js"),
        F.when(both, F.col("chi2")).alias("chi2"),
        F.when(both, chi2_p).alias("chi2_p"),
        "new_share",
        "z",
        two_sided_normal_p(F.col("z")).alias("z_p"),
    )


def _proportion_z(labelled: DataFrame) -> DataFrame:
    """z of the greater value's share, for columns of exactly two values (two rows each)."""
    hits = labelled.where("n_values = 2 AND ref_rows > 0 AND cur_rows > 0").groupBy("column", "ref_rows", "cur_rows").agg(
        F.max_by(F.struct("n_ref", "n_cur"), F.struct("number", "category")).alias("_hit")
    )
    n_ref, n_cur = F.col("_hit.n_ref").cast("double"), F.col("_hit.n_cur").cast("double")
    pooled = (n_ref + n_cur) / (F.col("ref_rows") + F.col("cur_rows"))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("ref_rows") + 1 / F.col("cur_rows")))
    z = F.try_divide(n_ref / F.col("ref_rows") - n_cur / F.col("cur_rows"), spread)
    return hits.select("column", z.alias("z"))


def drift_columns(
    frequencies: DataFrame,
    small_reference_rows: int = SMALL_REFERENCE_ROWS,
    p_value_threshold: float = P_VALUE_THRESHOLD,
    distance_threshold: float = DISTANCE_THRESHOLD,
) -> DataFrame:
    """One row per requested column: the selected method, its score, what kind of score it is, and the verdict.

    Small references use p-values (drift below the threshold), large ones distances (drift at
    or above it). Columns of at most five values, numeric or not, are compared by shares.

    A column with values on one side only has drifted (``emptied``), by the method 'missing' and without a
    score; one without any value on either side has that method too, and has not drifted.
    """
    stats = (
        missing_values(frequencies)
        .join(F.broadcast(share_statistics(frequencies)), "column", "left")
        .join(F.broadcast(ordered_statistics(frequencies)), "column", "left")
        .fillna(0, ["ref_rows", "cur_rows", "n_values"])
        .fillna(False, ["is_numeric"])
        .withColumn("emptied", (F.col("ref_rows") == 0) != (F.col("cur_rows") == 0))
    )
    ordered = F.col("is_numeric") & (F.col("n_values") > FEW_VALUES)
    small = F.col("ref_rows") <= small_reference_rows
    method = (
        F.when((F.col("ref_rows") == 0) | (F.col("cur_rows") == 0), "missing")
        .when(small & ordered, "ks")
        .when(small & (F.col("n_values") <= 2), "z")
        .when(small, "chi2")
        .when(ordered, "wasserstein")
        .otherwise("js")
    )
    score = (
        F.when(F.col("method") == "ks", F.col("ks_p"))
        # One value on both sides cannot differ; z is undefined there.
        .when(F.col("method") == "z", F.when(F.col("n_values") < 2, F.lit(1.0)).otherwise(F.col("z_p")))
        .when(F.col("method") == "chi2", F.col("chi2_p"))
        .when(F.col("method") == "wasserstein", F.col("wasserstein"))
        .when(F.col("method") == "js", F.col("js"))
    )
    is_p = F.col("method").isin("ks", "z", "chi2")
    return (
        stats.withColumn("method", method)
        .withColumn("score", score)
        .withColumn("score_kind", F.when(is_p, "pvalue").when(F.col("method") != "missing", "distance"))
        .withColumn("threshold", F.when(is_p, F.lit(p_value_threshold)).otherwise(F.lit(distance_threshold)))
        .withColumn("beyond", F.when(is_p, F.col("score") < F.col("threshold")).otherwise(F.col("score") >= F.col("threshold")))
        .withColumn("drifted", F.col("emptied") | F.coalesce("beyond", F.lit(False)))
        .select(
            "column", "is_numeric", "ref_rows", "cur_rows", "n_values", "new_share",
            "method", "score", "score_kind", "threshold", "drifted", "ref_missing", "cur_missing", "emptied",
        )
    )


def drift_summary(columns: DataFrame, target: str) -> DataFrame:
    """One row: counts and share of drifted columns, their names, those emptied, and the target's own score."""
    is_target = F.col("column") == target
    return columns.agg(
        F.count("*").alias("n_columns"),
        F.count_if("drifted").alias("n_drifted"),
        F.coalesce(F.try_divide(F.count_if("drifted"), F.count("*")), F.lit(0.0)).alias("share_drifted"),
        F.sort_array(F.collect_list(F.when(F.col("drifted"), F.col("column")))).alias("drifted_columns"),
        F.sort_array(F.collect_list(F.when(F.col("emptied"), F.col("column")))).alias("emptied_columns"),
        F.max(F.when(is_target, F.col("score"))).alias("target_score"),
        F.max(F.when(is_target, F.col("score_kind"))).alias("target_score_kind"),
        F.max(F.when(is_target, F.col("threshold"))).alias("target_threshold"),
    ).withColumn("dataset_drift", F.col("n_drifted") > 0)


def drift_gate(
    summary: DataFrame, max_share_drifted: float = 0.3, target_pvalue: float = P_VALUE_THRESHOLD,
    target_distance: float = DISTANCE_THRESHOLD,
) -> DataFrame:
    """Add ``violations``, ``passed`` and ``retrain`` (= not passed).

    The share must exceed its limit. A p-value fails below its limit, a distance at or above
    it; a null target score passes, but any column with values on one side only fails.
    """
    share, score = F.col("share_drifted"), F.col("target_score")
    kind = F.col("target_score_kind")
    checks = F.array(
        F.when(
            F.size("emptied_columns") > 0,
            F.concat(F.lit("values on one side only: "), F.array_join("emptied_columns", ", ")),
        ),
        F.when(
            share > max_share_drifted,
            F.concat(
                F.lit("share_of_drifted_columns "),
                F.format_string("%.2f%%", share * 100),
                F.lit(f" > threshold {max_share_drifted:.2%}"),
            ),
        ),
        F.when(
            (kind == "pvalue") & (score < target_pvalue),
            F.concat(F.lit("target_drift p-value "), F.format_string("%.4f", score), F.lit(f" < threshold {target_pvalue}")),
        ),
        F.when(
            (kind == "distance") & (score >= target_distance),
            F.concat(F.lit("target_drift distance "), F.format_string("%.4f", score), F.lit(f" >= threshold {target_distance}")),
        ),
    )
    violations = F.filter(checks, lambda text: text.isNotNull())
    passed = F.size(violations) == 0
    return summary.withColumns({"violations": violations, "passed": passed, "retrain": ~passed})
