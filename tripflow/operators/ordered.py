"""Running sums over sorted values and exact quantiles, without a one-task sort.

Works on a frequency table (one row per group and value), so a value that holds a third of
all rows is a single row here. Values are cut at approximate quantiles into ranges, as many as the
distinct values need; each range is sorted on its own, and the ranges' totals, one small row each, give the
offsets. The edges only steer the parallelism; the sums are exact whatever the edges are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.sources.storage import written

#: Distinct values sorted in one task, or so; the number of ranges follows from it.
RANGE_VALUES = 1 << 15
#: Size of the sketch the edges come from: its ranks are right to about 0.05 %, whatever the number of values.
SKETCH = 4096


def range_count(values: int, range_values: int = RANGE_VALUES) -> int:
    """Ranges for so many distinct values: a power of two, so that a binary search finds a value's range."""
    return 1 << max(0, -(-values // range_values) - 1).bit_length()


def range_edges(frequencies: DataFrame, group: str, value: str, range_values: int) -> tuple[DataFrame, int]:
    """``_edges`` of each group, and the number of ranges.

    They come from written sketches, as an edge must be the same wherever it is read and sketches draw at random.
    Sketches are merged, not values: a task holds one per group, and what it sends on does not grow with the data.
    """
    number = F.col(value).cast("double")
    sketched = written(
        frequencies.groupBy(group).agg(F.count("*").alias("_n"), F.kll_sketch_agg_double(number, SKETCH).alias("_sketch")), "edges"
    )
    count = range_count(sketched.agg(F.max("_n")).first()[0] or 0, range_values)
    ranks = ", ".join(f"{i / count!r}D" for i in range(1, count))
    edges = F.kll_sketch_get_quantile_double("_sketch", F.expr(f"array({ranks})")) if count > 1 else F.expr("array(0D)")
    return sketched.select(group, edges.alias("_edges")), count


def _with_range(df: DataFrame, value: str, edges: str, count: int) -> DataFrame:
    """Add ``_range``, the number of sorted edges below the value: a binary search, one column a step."""
    df = df.withColumn("_range", F.lit(0))
    step = count // 2
    while step:
        above = F.get(edges, F.col("_range") + (step - 1)) < F.col(value).cast("double")
        df = df.withColumn("_range", F.col("_range") + F.when(above, step).otherwise(0))
        step //= 2
    return df


def running_counts(
    frequencies: DataFrame, group: str, value: str, counts: list[str], range_values: int = RANGE_VALUES
) -> DataFrame:
    """Add ``running_<c>``, ``total_<c>`` for each count column, and ``next_value``.

    ``frequencies`` holds one row per (group, value), value neither null nor NaN. It is read
    twice (edges, sums), so pass a written table. ``group`` names a handful of columns, not
    data keys: the edges and the ranges' totals have a number per group and ``range_values`` values.
    """
    frequencies = frequencies.select(group, value, *counts)
    edges, count = range_edges(frequencies, group, value, range_values)
    # One shuffle serves both the totals and the sums inside the ranges.
    bucketed = (
        _with_range(frequencies.join(edges, group), value, "_edges", count)
        .drop("_edges")
        .repartition(group, "_range")
    )

    of_group = Window.partitionBy(group)
    by_range = of_group.orderBy("_range")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(group, "_range")
        .agg(F.min(value).alias("_first"), *[F.sum(c).alias(f"_sum_{c}") for c in counts])
        .select(
            group,
            "_range",
            F.lead("_first").over(by_range).alias("_next_first"),
            *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_offset_{c}") for c in counts],
            *[F.sum(f"_sum_{c}").over(of_group).alias(f"total_{c}") for c in counts],
        )
    )

    in_range = Window.partitionBy(group, "_range").orderBy(value)
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        bucketed.withColumns(
            {
                **{f"_in_{c}": F.sum(c).over(so_far) for c in counts},
                "_next": F.lead(value).over(in_range),
            }
        )
        .join(offsets, [group, "_range"])
        .select(
            group,
            value,
            *counts,
            *[(F.col(f"_in_{c}") + F.col(f"_offset_{c}")).alias(f"running_{c}") for c in counts],
            *[f"total_{c}" for c in counts],
            F.coalesce("_next", "_next_first").alias("next_value"),
        )
    )


#: Share of rows on either side of an estimated quantile that is searched for the exact one: five times the sketch's error.
MARGIN = 0.0025


def exact_quantiles(df: DataFrame, value: Column, probabilities: dict[str, float]) -> DataFrame:
    """One row: the smallest value whose share of rows at or below it reaches each probability.

    Equals ``percentile_disc``, which would hold every distinct value in one task's memory. A sketch tells between which two
    values each quantile lies. Rows below the first are only counted; the values between are counted one by one, so it is exact
    whatever the sketch says: where the counts show that a quantile lies elsewhere, all values are counted.
    """
    values = written(df.select(value.alias("_value")).where("_value IS NOT NULL"), "values")
    rows, brackets = _brackets(values, probabilities)
    counted = _counts_between(values, brackets) if brackets else None
    if counted is None:
        frequencies = values.groupBy(F.lit("value").alias("_group"), "_value").agg(F.count("*").alias("_n"))
        running = running_counts(written(frequencies, "frequencies"), "_group", "_value", ["_n"])
        return running.agg(
            *[
                F.min(F.when(F.col("running__n") >= F.lit(p) * F.col("total__n"), F.col("_value"))).alias(name)
                for name, p in probabilities.items()
            ]
        )
    frequencies, below = counted
    running = running_counts(frequencies, "_group", "_value", ["_n"])
    return running.agg(
        *[
            F.min(
                F.when((F.col("_group") == name) & (F.col("running__n") + below[name] >= F.lit(p) * F.lit(rows)), F.col("_value"))
            ).alias(name)
            for name, p in probabilities.items()
        ]
    )


def _brackets(values: DataFrame, probabilities: dict[str, float]) -> tuple[int, dict[str, tuple[float, float, float]]]:
    """Number of rows and, per name, the rows to reach and two values that the quantile most likely lies between."""
    number = F.col("_value").cast("double")
    sketch = written(values.agg(F.count("*").alias("_n"), F.kll_sketch_agg_double(number, SKETCH).alias("_sketch")), "sketch")
    rows = sketch.first()["_n"]
    if not rows:
        return 0, {}

    def at(rank: float) -> Column:
        return F.kll_sketch_get_quantile_double("_sketch", F.lit(min(max(rank, 0.0), 1.0)))

    ends = [at(p + side * MARGIN).alias(f"{name}_{side}") for name, p in probabilities.items() for side in (-1, 1)]
    found = sketch.select(*ends).first()
    inf = float("inf")
    return rows, {
        name: (
            p * rows,
            found[f"{name}_-1"] if p > MARGIN else -inf,
            found[f"{name}_1"] if p < 1 - MARGIN else inf,
        )
        for name, p in probabilities.items()
    }


def _counts_between(
    values: DataFrame, brackets: dict[str, tuple[float, float, float]]
) -> tuple[DataFrame, dict[str, int]] | None:
    """Rows (_group, _value, _n) of the values in each bracket, and the rows below it; None if a quantile is in none."""
    number = F.col("_value").cast("double")
    inside = {name: number.between(low, high) for name, (_, low, high) in brackets.items()}
    names = F.array(*[F.when(i, F.lit(name)) for name, i in inside.items()])
    frequencies = written(
        values.select("_value", F.explode(F.array_compact(names)).alias("_group")).groupBy("_group", "_value").agg(F.count("*").alias("_n")),
        "frequencies",
    )
    sums = [F.count_if(number < low).alias(f"{name}_below") for name, (_, low, _) in brackets.items()]
    sums += [F.count_if(i).alias(f"{name}_inside") for name, i in inside.items()]
    found = values.agg(*sums).first()
    for name, (least, _, _) in brackets.items():
        below = found[f"{name}_below"]
        if not (below < least <= below + found[f"{name}_inside"]):
            return None
    return frequencies, {name: found[f"{name}_below"] for name in brackets}
