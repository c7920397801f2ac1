"""The registered queries over empty tables, and over tables whose extra columns have the operators' own names."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tripflow.llm import queries

TABLES = ["documents", "labels", "pages", "embeddings"]
QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
CLASHING = ["_range", "text_hash", "h", "n", "label", "vector", "size", "word", "rank", "component_id", "record_type"]


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def clashing(spark, sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clashing"))
    for name in TABLES:
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        extra = [f"'mine' AS {c}" for c in CLASHING if c not in table.columns]
        table.selectExpr("*", *extra).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", QUERIES)
def test_nothing_comes_of_empty_tables(spark, empty, name):
    found = QUERIES[name](spark, empty)
    assert found.columns and found.count() == 0


@pytest.mark.parametrize("name", ["op2_warc", "op3_topk", "op5_fingerprint", "op12_filter_audit"])
def test_extra_columns_change_nothing(spark, sf, clashing, name):
    own, other = (sorted(map(str, QUERIES[name](spark, folder).collect())) for folder in (sf, clashing))
    assert own and own == other
