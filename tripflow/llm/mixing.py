"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in an order shuffled by a hash of the id, run through
``most_repeats`` times. A document's virtual finish time is the words of its source up to and with
it, divided by the source's target; all queues together are taken in order of finish time until the total
budget is spent. A source that gets its target is finished at time 1.

No queue is sorted in one task: a source is cut into ranges of the hash whose number follows the row count, range totals give each
range its start, and only the ranges are sorted. Of the global order, too, totals by range of
finish time find the one range that holds the cut, and only that is sorted.

Defined results: null texts have no words; a document without words takes its turn like others but
takes no words; a source without words has target 0 and its documents are not taken. The null source is
one source, last in order. Rows that are repeated or share an id each have their own place in the queue, in
the order of their texts. An empty table gives an empty result. Columns that clash with the results' names are
replaced; others pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm import common

RESULTS = ("size", "source_size", "target", "times", "taken")
HASH_BITS = 60


def words(text: str = "text") -> Column:
    return F.expr(f"coalesce(regexp_count({text}, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0)").cast("long")


def place(seed: int, doc_id: str = "doc_id") -> Column:
    """A number below 2 ** 60 fixed by the id and the seed, alike in any engine."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col(doc_id).cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most_repeats: int) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from the words per source.

    The budget is dealt by weight; what a source cannot take is dealt again to the others.
    One row per source; the ranks for the repeating weights come from a sort of these rows.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    sources = common.stored(sizes.withColumn("weight", weight), "mixing-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap, level = F.col("source_size") * float(most_repeats), None
    while True:
        free = F.lit(True) if level is None else F.col("weight") * level <= cap
        row = sources.agg(
            F.sum(F.when(~free, cap).otherwise(0.0)).alias("held"), F.sum(F.when(free, F.col("weight"))).alias("w")
        ).first()
        if not row["w"]:
            break
        level, before = (share * total - row["held"]) / row["w"], level
        if level == before:
            break
    target = F.least(cap, F.col("weight") * (level if level is not None else 0.0))
    return sources.select(F.col("source").alias("_source"), "source_size", target.alias("target"))


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most_repeats: int = 2,
    seed: int = 11,
    range_rows: int = 20_000,
) -> DataFrame:
    """``documents`` with ``size``, ``source_size``, ``target``, ``times`` (turns taken) and ``taken`` (words)."""
    kept = [c for c in documents.columns if c not in RESULTS]
    sized = documents.select(*kept, words().alias("size"))
    keys = common.stored(
        documents.select("source", words().alias("size"), place(seed).alias("_place")), "mixing-keys"
    )
    per_source = keys.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(per_source.drop("rows"), weights, share, most_repeats)
    targets = common.stored(targets, "mixing-targets")
    summary = targets.agg(F.sum("source_size").alias("words")).first()
    budget = share * (summary["words"] or 0)
    ranges = max(1, math.ceil(keys.count() / range_rows))

    start = F.sum("range_size").over(
        Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    in_range = F.floor(F.col("_place") / float(1 << HASH_BITS) * ranges).cast("long")
    starts = common.stored(
        keys.groupBy(F.col("source").alias("_source"), in_range.alias("_range"))
        .agg(F.sum("size").alias("range_size"))
        .select("_source", "_range", F.coalesce(start, F.lit(0)).alias("_start")),
        "mixing-starts",
    )

    def queued(rows: DataFrame, *ties: str) -> DataFrame:
        """Words of the source up to and with each row, and the finish time of its first turn."""
        order = Window.partitionBy("source", "_range").orderBy("_place", *ties)
        within = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
        placed = (
            rows.withColumn("_range", in_range)
            .withColumn("_within", within)
            .alias("r")
            .join(
                starts.alias("s"),
                F.col("r.source").eqNullSafe(F.col("s._source")) & (F.col("r._range") == F.col("s._range")),
            )
            .select("r.*", (F.col("_within") + F.col("_start")).alias("_upto"))
        )
        return placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_range", "_within")

    first = F.when(F.col("target") > 0, F.col("_upto") / F.col("target"))
    turn = lambda k: (F.col("_upto") + k * F.col("source_size")) / F.col("target")

    queue = queued(sized.withColumn("_place", place(seed)), *[c for c in ("doc_id", "text") if c in kept])
    light = queued(keys, "size").where("target > 0")
    turns = light.select(
        "size", "source", "_place", F.explode(F.array(*[
            F.struct(turn(k).alias("finish"), F.lit(k).alias("turn")) for k in range(most_repeats)
        ])).alias("t"),
    ).select("size", "source", "_place", "t.*")
    cut = _cut(common.stored(turns, "mixing-turns"), budget, ranges)
    times = F.lit(0)
    for k in range(most_repeats):
        times = times + F.when(first.isNotNull() & (_order(turn(k), F.lit(k)) <= cut), 1).otherwise(0)
    return queue.withColumn("times", times).select(
        *kept, "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken")
    )


def _order(finish: Column, turn: Column) -> Column:
    return F.struct(
        finish.alias("finish"), F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("source"),
        F.col("_place").alias("place"), turn.alias("turn"),
    )


def _cut(turns: DataFrame, budget: float, ranges: int) -> Column:
    """The last turn, in the global order, up to which all words together stay within the budget."""
    spot = F.least(F.floor(F.col("finish") * ranges), F.lit(4 * ranges)).cast("long")
    ranged = turns.withColumn("_spot", spot)
    totals = ranged.groupBy("_spot").agg(F.sum("size").alias("size")).orderBy("_spot").collect()  # 4 * ranges + 1 at most
    before, at = 0, -1
    for row in totals:
        if before + row["size"] > budget:
            at = row["_spot"]
            break
        before += row["size"]
    if at == -1:
        return F.struct(F.lit(float("inf")).alias("finish"), F.lit(True).alias("last"), F.lit("").alias("source"),
                        F.lit(0).cast("long").alias("place"), F.lit(0).alias("turn"))
    running = F.sum("size").over(
        Window.partitionBy("_spot").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    )
    last = (
        ranged.where(F.col("_spot") == at)
        .select("_spot", "size", _order(F.col("finish"), F.col("turn")).alias("_key"))
        .withColumn("running", running)
        .where(F.col("running") + before <= budget)
        .agg(F.max("_key").alias("k"))
        .first()["k"]
    )
    if last is None:  # the cut is the range's lower end
        finish, last_source, source, spot_place, turn = at / ranges, False, "", -1, 0
    else:
        finish, last_source, source, spot_place, turn = last
    return F.struct(F.lit(finish).alias("finish"), F.lit(last_source).alias("last"), F.lit(source).alias("source"),
                    F.lit(spot_place).cast("long").alias("place"), F.lit(turn).alias("turn"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(documents).select("doc_id", "size", "source_size", "target", "taken")


SQL = """
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('11|' || doc_id), 1, 15))::BIGINT AS place
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3e0, 1e0, 2e0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT *, 2e0 * source_size AS cap,
         (1.5e0 * sum(source_size) OVER ()::DOUBLE
           - coalesce(sum(2e0 * source_size) OVER (ORDER BY 2e0 * source_size / weight, source NULLS LAST
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 2e0 * source_size / weight, source NULLS LAST
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0)) AS level
  FROM sources
), targets AS (
  SELECT source, source_size,
         least(cap, weight * (SELECT max(level) FROM levels)) AS target FROM levels
), turns AS (
  SELECT doc_id, d.source, size, place, turn,
         (sum(size) OVER (PARTITION BY d.source, turn ORDER BY place) + turn * source_size)::DOUBLE / target AS finish
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1]) AS turn)
  WHERE target > 0
), taken AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, place, turn
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM turns
)
SELECT d.doc_id, d.size, t.source_size, t.target,
       coalesce((SELECT sum(size) FROM taken k
                 WHERE k.doc_id = d.doc_id AND upto <= 1.5e0 * (SELECT sum(size) FROM docs)), 0)::BIGINT AS taken
FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
"""
