"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of integer weights, floor(256 x) by position, zeros left out. Queries and candidates
are cut into blocks by a hash, whose numbers follow the row counts, and every pair of blocks is one piece of work of
bounded size. In it the candidates become postings (position -> candidates and weights); each query scatters
its weights times the postings into a dense array of scores, of which a partial sort selects the k
best. The blocks' selections are merged by rank, a limit that also acts before the shuffle.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part, nor do null ids.
An empty vector scores 0 with all. Lengths may differ; missing components are 0. Rows equal in id and vector
count once; an id with several vectors is several candidates and queries (told apart by ``query_vector``), none of
which is matched with its own id. Scores beyond a long are held at its ends. Ties go to the smaller id. Without queries
or other rows the result is empty.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm import common

LONG = np.iinfo(np.int64)


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part, equal rows once."""
    doubles = F.col(vector).cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull())
        .where(F.coalesce(finite, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("vector"))
        .distinct()
    )


def weights(vectors: list[np.ndarray]) -> np.ndarray:
    """floor(256 x) as a matrix, shorter rows filled with zeros; Python integers where 64 bits might not do."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    if out.size and np.abs(out).max() >= 2.0**23:
        exact = np.empty(out.shape, dtype=object)
        # From 2^53 on numbers are whole, and 256 times the largest is no double.
        exact[:] = [[int(x) * 256 if abs(x) >= 2.0**53 else math.floor(256.0 * x) for x in row] for row in out]
        return exact
    return np.floor(256.0 * out).astype(np.int64)


def postings(matrix: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """Candidates and weights by position; all candidates where most have a weight."""
    lists = []
    for column in matrix.T:
        rows = np.flatnonzero(column)
        lists.append((slice(None), np.ascontiguousarray(column)) if 2 * len(rows) > len(column) else (rows, column[rows]))
    return lists


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k highest scores, ties to the smaller id; ``ids`` ascend."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        level = np.flatnonzero(scores == least)[: k - len(above)]
        picked = np.sort(np.concatenate([above, level]))
    else:
        picked = np.arange(len(scores))
    return picked[np.lexsort((ids[picked], -scores[picked]))]


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of ``rows`` for each of ``queries`` (vec_id, vector; queries also their number)."""
    out = []
    if len(queries) and len(rows):
        rows = rows.sort_values("vec_id", kind="stable")
        ids = rows["vec_id"].to_numpy()
        matrix, asked = weights(list(rows["vector"])), weights(list(queries["vector"]))
        largest = int(np.abs(matrix).max(initial=0)) * int(np.abs(asked).max(initial=0)) * max(matrix.shape[1], 1)
        kind = np.int32 if largest < 2**31 else np.int64 if largest < 2**62 else object
        lists = postings(matrix.astype(kind))
        for name, number, row in zip(queries["vec_id"], queries["query_vector"], asked.astype(kind), strict=True):
            scores = np.zeros(len(ids), dtype=kind)
            for term in np.flatnonzero(row[: len(lists)]):
                places, weight = lists[term]
                scores[places] += row[term] * weight
            if kind is object:
                scores = np.array([min(max(int(s), LONG.min), LONG.max) for s in scores], dtype=np.int64)
            others = np.flatnonzero(ids != name)
            picked = others[best(scores[others].astype(np.int64), ids[others], k)]
            out += [(name, number, ids[i], int(scores[i])) for i in picked]
    return pd.DataFrame(out, columns=["query_id", "query_vector", "vec_id", "score"])


def search(
    queries: DataFrame, rows: DataFrame, k: int = 5, query_block: int = 512, row_block: int = 8_192
) -> DataFrame:
    """``query_id``, ``query_vector`` (hash), ``rank``, ``vec_id`` and ``score``; both inputs as ``usable`` gives them."""
    query_blocks = max(1, math.ceil(queries.count() / query_block))
    row_blocks = max(1, math.ceil(rows.count() / row_block))
    place = F.xxhash64("vec_id", "vector")
    asked = queries.select(
        "vec_id", "vector", place.alias("query_vector"), F.pmod(place, F.lit(query_blocks)).alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)).cast("array<long>")).alias("r"),
    )
    dealt = rows.select(
        "vec_id", "vector", F.pmod(place, F.lit(row_blocks)).alias("r"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<long>")).alias("q"),
    )
    found = (
        asked.groupBy("q", "r")
        .cogroup(dealt.groupBy("q", "r"))
        .applyInPandas(
            lambda a, b: search_block(a, b, k), "query_id long, query_vector long, vec_id long, score long"
        )
    )
    order = Window.partitionBy("query_id", "query_vector").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.stored(usable(common.table(spark, sf_dir, "embeddings")), "topk-vectors")
    found = search(rows.where("vec_id % 50 = 0"), rows)
    return found.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
