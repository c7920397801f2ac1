"""How five quality filters act on one another, in every order they could be applied in.

Each document fails or passes each filter, so it lies in one of 2 x 2 x 2 x 2 x 2 cells. Spark counts the
documents, the good and the toxic ones per part and cell; that is all the rest needs, as no filter looks at
what another removed. A part's counts are a tensor with an axis per filter, and every figure is a
contraction of it that takes the passing, the failing or all entries of each axis. 32 cells stand for a part of
any size, so a part that holds most documents costs no more than the others.

Filters: A under 200 words; B fewer than half of the words distinct; C more than 2 % of the code points in A-Z;
D any of ``#$%&*|``; E the text of a smaller doc_id. Words are maximal runs of ``[^\\x20\\x09-\\x0D]``.

Texts are compared by SHA-256. The smallest id of each text is found by an aggregate, and rows look themselves
up there by id and text together: a text shared by many rows is no hot key.

Defined results: a null text counts as empty, a null part as the empty string. A row with a null id has no
smaller one: it passes E, is no smaller id to others, and has no label. Rows repeated with the same id all count, and
pass E together. An id labelled twice is good (toxic) if any of its labels says so. An empty table
has no parts and gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

FILTERS = "ABCDE"
ORDERS = list(itertools.permutations(range(len(FILTERS))))
COUNTS = ["documents", "good", "toxic"]
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
#: Parts contracted at once: bounds the memory of a task, whatever the number of parts.
PARTS_AT_ONCE = 128

RESULT = (
    "part string, filter_order string, step int, filter string, kept long, removed long, redundant long,"
    " unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> dict[str, Column]:
    """Whether the (non-null) text fails each filter that looks at nothing but the text."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * upper > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def cells(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Rows (part, cell, documents, good, toxic); ``cell`` has a bit per filter, A the highest, set if it fails."""
    text = F.coalesce(F.col("text"), F.lit(""))
    failures = text_failures(text)
    four = sum((F.when(failures[f], 16 >> i).otherwise(0) for i, f in enumerate("ABCD")), F.lit(0))
    # Narrow from here on: the text itself is not shuffled. Repeated rows become one before that.
    rows = common.stored(
        documents.select(
            F.col("doc_id").cast("long").alias("id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            four.alias("four"),
        )
        .groupBy("id", "digest", "part", "four")
        .agg(F.count("*").alias("n")),
        "audit-rows",
    )
    first = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    # Rows without an id find no label; their own second key spreads them over the tasks.
    known = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(*[F.max((F.col(c) == 1).cast("int")).alias(name) for c, name in (("quality", "is_good"), ("toxic", "is_toxic"))])
        .withColumn("spread", F.lit(0).cast("long"))
    )
    fifth = F.when(F.col("id").isNull() | F.col("is_first"), 0).otherwise(1)
    return (
        rows.withColumn("spread", F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(0))
        .join(first, ["id", "digest"], "left")
        .join(known, ["id", "spread"], "left")
        .groupBy("part", (F.col("four") + fifth).alias("cell"))
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
        )
    )


def contract(tensors: np.ndarray, choices: np.ndarray) -> np.ndarray:
    """Sums of ``tensors`` (part, A, B, C, D, E) over what each of ``choices`` (choice, axis, pass/fail) takes."""
    return np.einsum("nabcde,ka,kb,kc,kd,ke->nk", tensors, *choices.transpose(1, 0, 2), optimize=True)


def _choices(taken: list[dict[int, tuple[int, int]]]) -> np.ndarray:
    """Per choice and axis what is taken; all where nothing is said."""
    return np.array([[t.get(axis, ALL) for axis in range(len(FILTERS))] for t in taken], np.int64)


def figures(documents: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Every count of the audit, as (part, order * 5 + step), from tensors (part, 2, 2, 2, 2, 2)."""
    axes = range(len(FILTERS))
    steps = [(order, k) for order in ORDERS for k in axes]
    kept = _choices([dict.fromkeys(order[: k + 1], PASS) for order, k in steps])
    removed = _choices([{**dict.fromkeys(order[:k], PASS), order[k]: FAIL} for order, k in steps])
    failing = _choices([{f: FAIL} for f in axes])
    alone = _choices([{**dict.fromkeys(axes, PASS), f: FAIL} for f in axes])
    filter_of = np.array([order[k] for order, k in steps])

    lost = contract(documents, removed)
    shapley = np.stack([lost[:, filter_of == f].sum(axis=1) for f in axes], axis=1)
    return {
        "kept": contract(documents, kept),
        "removed": lost,
        "redundant": contract(documents, failing)[:, filter_of] - lost,
        "unique_fails": contract(documents, alone)[:, filter_of],
        "good_lost": contract(good, removed),
        "toxic_lost": contract(toxic, removed),
        "shapley": shapley[:, filter_of],
    }


def _contracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    orders = ["".join(FILTERS[f] for f in order) for order in ORDERS]
    width = len(ORDERS) * len(FILTERS)
    for batch in batches:
        for start in range(0, len(batch), PARTS_AT_ONCE):
            some = batch.iloc[start : start + PARTS_AT_ONCE]
            tensors = np.zeros((len(COUNTS), len(some), 1 << len(FILTERS)), np.int64)
            for i, found in enumerate(some["cell"]):
                for k, name in enumerate(COUNTS):
                    tensors[k, i, found] = some[name].iloc[i]
            shaped = tensors.reshape(len(COUNTS), len(some), *[2] * len(FILTERS))
            yield pd.DataFrame(
                {
                    "part": np.repeat(some["part"].to_numpy(object), width),
                    "filter_order": np.tile(np.repeat(orders, len(FILTERS)), len(some)),
                    "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(some) * len(ORDERS)),
                    "filter": np.tile([f for order in orders for f in order], len(some)),
                    **{name: values.reshape(-1) for name, values in figures(*shaped).items()},
                }
            )


def audit(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step. ``documents`` has doc_id, text and the part."""
    per_part = (
        cells(documents, labels, part)
        .groupBy("part")
        .agg(F.collect_list(F.struct("cell", *COUNTS)).alias("cells"))  # 32 at most
        .select("part", *[F.col(f"cells.{c}").alias(c) for c in ("cell", *COUNTS)])
    )
    return per_part.mapInPandas(_contracted, RESULT)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


_WORDS = r"list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_BIT = {f: 16 >> i for i, f in enumerate(FILTERS)}
_OTHERS = " AND ".join(f"{a}.f <> {b}.f" for a, b in itertools.combinations("vwxyz", 2))

SQL = f"""
WITH texts AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS t FROM documents),
measured AS (
  SELECT doc_id, part, t, len({_WORDS}) AS words, list_unique({_WORDS}) AS different,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper, MIN(doc_id) OVER (PARTITION BY t) AS first
  FROM texts),
known AS (
  SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part,
    CASE WHEN words < 200 THEN 16 ELSE 0 END + CASE WHEN 100 * different < 50 * words THEN 8 ELSE 0 END
    + CASE WHEN 100 * upper > 2 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 2 ELSE 0 END
    + CASE WHEN doc_id > first THEN 1 ELSE 0 END AS cell,
    COUNT(*) AS documents, SUM(COALESCE(good, 0)) AS good, SUM(COALESCE(toxic, 0)) AS toxic
  FROM measured LEFT JOIN known USING (doc_id) GROUP BY ALL),
letters AS (SELECT UNNEST(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT v.f || w.f || x.f || y.f || z.f AS filter_order
  FROM letters v, letters w, letters x, letters y, letters z WHERE {_OTHERS}),
bits AS (SELECT f, CASE f {' '.join(f"WHEN '{f}' THEN {b}" for f, b in _BIT.items())} END AS bit FROM letters),
steps AS (
  SELECT filter_order, step, f AS filter, bit,
    COALESCE((SELECT SUM(b.bit) FROM bits b WHERE strpos(filter_order, b.f) < step), 0) AS before
  FROM orders, (SELECT UNNEST([1, 2, 3, 4, 5]) AS step), bits WHERE substr(filter_order, step, 1) = f),
counted AS (
  SELECT part, filter_order, step, filter,
    SUM(CASE WHEN cell & CAST(before + bit AS INTEGER) = 0 THEN documents ELSE 0 END) AS kept,
    SUM(CASE WHEN cell & CAST(before AS INTEGER) = 0 AND cell & bit > 0 THEN documents ELSE 0 END) AS removed,
    SUM(CASE WHEN cell & CAST(before AS INTEGER) > 0 AND cell & bit > 0 THEN documents ELSE 0 END) AS redundant,
    SUM(CASE WHEN cell = bit THEN documents ELSE 0 END) AS unique_fails,
    SUM(CASE WHEN cell & CAST(before AS INTEGER) = 0 AND cell & bit > 0 THEN good ELSE 0 END) AS good_lost,
    SUM(CASE WHEN cell & CAST(before AS INTEGER) = 0 AND cell & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(SUM(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""
