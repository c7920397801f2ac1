"""Train, test and validation splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions.time import epoch_seconds
from tripflow.operators.ordered import exact_quantiles
from tripflow.sources.storage import key_fraction

# --- fixed values: the middle part is 'test', the tail is 'val' ---
TRAIN_SHARE = 0.70
TEST_SHARE = 0.85


def split_thresholds(df: DataFrame, ts: str = schema.PICKUP) -> DataFrame:
    """Pickup seconds that end the train and the test part; one row."""
    return exact_quantiles(df, epoch_seconds(F.col(ts)), {"train_until": TRAIN_SHARE, "test_until": TEST_SHARE})


def split_label(seconds: Column, train_until: Column, test_until: Column) -> Column:
    return F.when(seconds <= train_until, "train").when(seconds <= test_until, "test").otherwise("val")


def time_split(df: DataFrame, ts: str = schema.PICKUP, thresholds: DataFrame | None = None) -> DataFrame:
    """Add ``split`` by pickup time: train up to 70 % of rows, test to 85 %, val after.

    Trips of one second stay together. The thresholds enter as a scalar subquery, so rows
    are labelled where they are: no sort, no shuffle of the trips.
    """
    if thresholds is None:
        thresholds = split_thresholds(df, ts)
    limits = thresholds.select(F.struct("train_until", "test_until")).scalar()
    label = split_label(epoch_seconds(F.col(ts)), limits["train_until"], limits["test_until"])
    return df.withColumn("split", label)


def random_split(df: DataFrame, key: list[str], train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``split`` by a hash of the key: the same rows in any partitioning and after any retry."""
    return df.withColumn("split", F.when(key_fraction(key, seed) < train_share, "train").otherwise("test"))


def union_splits(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)
