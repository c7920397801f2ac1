"""Fit encoders and scalers on the training rows, apply them to any rows.

Fitted state has two forms. What grows with columns only (levels, mean and stddev) is
brought to the driver and becomes literals. What grows with data keys (target means per
zone) stays a written table and is joined.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.sources.storage import written


def drop_leakage(df: DataFrame) -> DataFrame:
    return df.drop(*schema.LEAKAGE_COLUMNS, *schema.NON_PREDICTIVE_COLUMNS)


def encode_binary(df: DataFrame, columns: list[str] = schema.BINARY_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) == "Y", 1).otherwise(0) for c in columns if c in df.columns})


# --- one-hot -------------------------------------------------------------------------------


def category_levels(df: DataFrame, columns: list[str] = schema.ONEHOT_COLUMNS) -> DataFrame:
    """Distinct non-null integer values of each column, as rows (column, level).

    The combinations are counted first, so each row of the input is read once.
    """
    combinations = df.select(*[F.col(c).cast("int").alias(c) for c in columns]).distinct()
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in columns])
    return combinations.select(F.inline(pairs)).where("level IS NOT NULL").distinct()


def fit_levels(df: DataFrame, columns: list[str] = schema.ONEHOT_COLUMNS) -> dict[str, list[int]]:
    """Sorted levels without the first, per column: one per 0/1 column that the caller asks for."""
    rows = category_levels(df, columns).collect()
    return {c: sorted(r["level"] for r in rows if r["column"] == c)[1:] for c in columns}


def encode_onehot(df: DataFrame, levels: dict[str, list[int]]) -> DataFrame:
    """0/1 column per fitted level; null and unseen values are all zeros; the source is dropped."""
    flags = {
        f"{c}_{level}": F.when(F.col(c).cast("int") == level, 1).otherwise(0)
        for c, values in levels.items()
        if c in df.columns
        for level in values
    }
    return df.withColumns(flags).drop(*levels)


# --- target encoding -----------------------------------------------------------------------


def target_means(df: DataFrame, columns: list[str], target: str = schema.TARGET) -> DataFrame:
    """Rows (column, category, mean_target) plus a row of nulls with the global mean.

    One grouping-sets aggregate over the training rows; null categories have no row.
    """
    sets = [[F.col(c)] for c in columns] + [[]]
    # grouping() tells a missing key from a null one; the last set has every key missing.
    absent = [F.grouping(c) == 1 for c in columns]
    grouped = df.groupingSets(sets, *columns).agg(
        F.avg(target).alias("mean_target"),
        *[F.grouping(c).alias(f"_absent_{c}") for c in columns],
    )
    column, category = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for c in columns:
        present = F.col(f"_absent_{c}") == 0
        column = F.when(present, c).otherwise(column)
        category = F.when(present, F.col(c).cast("bigint")).otherwise(category)
    return (
        grouped.select(column.alias("column"), category.alias("category"), "mean_target")
        .where("column IS NULL OR category IS NOT NULL")
    )


def global_mean(means: DataFrame) -> Column:
    return means.where("column IS NULL").select("mean_target").scalar()


def encode_target(df: DataFrame, means: DataFrame, columns: list[str], keep_source: bool = False) -> DataFrame:
    """``{column}_encoded``: the category's training mean, the global mean where it has none.

    ``means`` should be a written table: joins then broadcast it only while it is small.
    """
    overall = global_mean(means)
    for c in columns:
        own = means.where(F.col("column") == c).select(
            F.col("category").alias(f"_{c}"), F.col("mean_target").alias("_mean")
        )
        df = (
            df.join(own, F.col(c).cast("bigint") == F.col(f"_{c}"), "left")
            .withColumn(f"{c}_encoded", F.coalesce("_mean", overall))
            .drop(f"_{c}", "_mean")
        )
    return df if keep_source else df.drop(*columns)


# --- scaling -------------------------------------------------------------------------------


def scaling_stats(df: DataFrame, columns: list[str] = schema.SCALED_COLUMNS) -> DataFrame:
    """Rows (column, mean, stddev), all columns in one aggregate; stddev null or 0 → 1, mean null → 0."""
    present = [c for c in columns if c in df.columns]
    row = df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in present],
        *[F.stddev_samp(c).alias(f"{c}__stddev") for c in present],
    )
    stats = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(f"{c}__mean", F.lit(0.0)).alias("mean"),
                F.when(F.col(f"{c}__stddev") > 0, F.col(f"{c}__stddev")).otherwise(1.0).alias("stddev"),
            )
            for c in present
        ]
    )
    return row.select(F.inline(stats))


def fit_scaling(df: DataFrame, columns: list[str] = schema.SCALED_COLUMNS) -> dict[str, tuple[float, float]]:
    return {r["column"]: (r["mean"], r["stddev"]) for r in scaling_stats(df, columns).collect()}


def scale_features(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c) - F.lit(mean)) / F.lit(std if std > 0 else 1.0) for c, (mean, std) in stats.items() if c in df.columns}
    )


# --- the whole model table -----------------------------------------------------------------


@dataclass
class Encoders:
    """All state fitted on the training rows."""

    levels: dict[str, list[int]]
    scaling: dict[str, tuple[float, float]]
    means: DataFrame
    target_columns: list[str] = field(default_factory=lambda: list(schema.TARGET_ENCODED_COLUMNS))

    def as_rows(self) -> DataFrame:
        """State as rows (kind, column, key, value), to be stored with the splits.

        A row names each one-hot column, also one without levels, and each target column with its place.
        """
        rows = [("onehot", c, None, None) for c in self.levels]
        rows += [("target", c, str(i), None) for i, c in enumerate(self.target_columns)]
        rows += [("level", c, str(v), float(v)) for c, values in self.levels.items() for v in values]
        rows += [("mean", c, None, m) for c, (m, _) in self.scaling.items()]
        rows += [("stddev", c, None, s) for c, (_, s) in self.scaling.items()]
        small = self.means.sparkSession.createDataFrame(rows, "kind string, column string, key string, value double")
        return small.unionByName(
            self.means.select(
                F.lit("target_mean").alias("kind"),
                "column",
                F.col("category").cast("string").alias("key"),
                F.col("mean_target").alias("value"),
            )
        )

    @staticmethod
    def from_rows(rows: DataFrame) -> Encoders:
        small = rows.where("kind <> 'target_mean'").collect()
        levels: dict[str, list[int]] = {r["column"]: [] for r in small if r["kind"] == "onehot"}
        for r in small:
            if r["kind"] == "level":
                levels[r["column"]].append(int(r["key"]))
        targets = sorted((int(r["key"]), r["column"]) for r in small if r["kind"] == "target")
        means = {r["column"]: r["value"] for r in small if r["kind"] == "mean"}
        stddevs = {r["column"]: r["value"] for r in small if r["kind"] == "stddev"}
        return Encoders(
            levels={c: sorted(v) for c, v in levels.items()},
            scaling={c: (means[c], stddevs[c]) for c in means},
            means=rows.where("kind = 'target_mean'").select(
                "column", F.col("key").cast("bigint").alias("category"), F.col("value").alias("mean_target")
            ),
            target_columns=[c for _, c in targets],
        )


def fit_encoders(train: DataFrame, target: str = schema.TARGET) -> Encoders:
    columns = [c for c in schema.TARGET_ENCODED_COLUMNS if c in train.columns]
    return Encoders(
        levels=fit_levels(train, [c for c in schema.ONEHOT_COLUMNS if c in train.columns]),
        scaling=fit_scaling(train),
        means=written(target_means(train, columns, target), "target-means"),
        target_columns=columns,
    )


def apply_encoders(df: DataFrame, encoders: Encoders) -> DataFrame:
    encoded = encode_target(encode_onehot(encode_binary(df), encoders.levels), encoders.means, encoders.target_columns)
    return scale_features(encoded, encoders.scaling)


def align_features(df: DataFrame, features: list[str] = schema.FEATURES, keep: list[str] | None = None) -> DataFrame:
    """The features in their order, absent ones as 0, after the columns to keep."""
    return df.select(
        *(keep or []), *[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in features]
    )


def save_model_table(table: DataFrame, encoders: Encoders, path: str, compression: str = "snappy") -> None:
    """Write the splits (a folder each) and the whole fitted state beside them."""
    table.write.mode("overwrite").partitionBy("split").option("compression", compression).parquet(f"{path}/splits")
    encoders.as_rows().write.mode("overwrite").parquet(f"{path}/state")


def load_encoders(spark: SparkSession, path: str) -> Encoders:
    return Encoders.from_rows(spark.read.parquet(f"{path}/state"))


def model_table(split_gold: DataFrame) -> tuple[DataFrame, Encoders]:
    """Gold rows with ``split`` → encoded, scaled rows; state is fitted on 'train' only.

    The input is read several times (levels, means, scaling, output): pass a written table.
    """
    narrow = drop_leakage(split_gold)
    encoders = fit_encoders(narrow.where("split = 'train'"))
    return apply_encoders(narrow, encoders), encoders
