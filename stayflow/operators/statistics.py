"""Exact statistics of groups that may hold a third of all rows, without a group's values in one task.

Values are counted once for each group and value, and the counts are written: every statistic of a report starts from them. Ranks come
from a histogram of coarse steps of the value; a step that holds a wanted rank and too many values is split into parts of its own
range, again and again until it doesn't, so the values that are put in order are at most `FULL` a rank, however close together they lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

QUARTILES = (0.25, 0.5, 0.75)
#: Steps to a doubling of the value.
STEPS = 64
#: Different values of a step that are put in order by one task at most, parts that a fuller one is split into at most, and splits.
FULL, PARTS, SPLITS = 50_000, 65_536, 60


def count_values(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, value and _c: the number of rows of each group and value, null too. Written, as several statistics start from it."""
    return stage(df.groupBy(*by, value).agg(F.count("*").alias("_c")), "value-counts")


def step_of(value: Column) -> Column:
    """A whole number that never falls as the value rises."""
    size = F.floor(F.least(F.log2(F.abs(value)) * STEPS, F.lit(1e5))) + 100_000
    return F.when(F.isnan(value), 300_000).when(value == 0, 0).when(value > 0, size).otherwise(-size)


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys``, which ``b`` has under names with an underscore in front."""
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"_{k}"]) for k in keys))


def spread(counts: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """by, n, min, max and _q (the percentiles, interpolated) of each group with values, from ``count_values``."""
    counts = counts.where(F.col(value).isNotNull()).withColumn("_step", step_of(F.col(value)).cast("string"))
    group = Window.partitionBy(*by)
    at = [F.lit(p) * (F.col("n") - 1) for p in probabilities]
    ranks = [(F.floor(x), F.ceil(x)) for x in at]
    wanted = reduce(lambda a, b: a | b, ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_s")) for pair in ranks for r in pair))
    until = lambda order: Window.partitionBy(*order[:-1]).orderBy(order[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum("_c").alias("_s"), F.count("*").alias("_v"), F.min(value).alias("_low"), F.max(value).alias("_high")]
    steps = counts.groupBy(*by, "_step").agg(*sums).withColumn("_order", F.col("_step").cast("int"))
    before = F.coalesce(F.sum("_s").over(until([*by, "_order"])), F.lit(0))
    steps = steps.select(*by, "_step", "_s", "_v", "_low", "_high", before.alias("_before"), F.sum("_s").over(group).alias("n"), F.min("_low").over(group).alias("min"), F.max("_high").over(group).alias("max"))
    steps, near = stage(steps.where(wanted), "steps"), counts
    for _ in range(SPLITS):
        if steps.where(F.col("_v") > FULL).isEmpty():
            break
        near, steps = _split(near, steps, by, value, wanted, sums, until)
    near = _of_steps(near, steps, [*by, "_step"], ["_before", "n", "min", "max"])
    end = F.col("_before") + F.sum("_c").over(Window.partitionBy(*by, "_step").orderBy(value))
    near = near.select(*by, value, "n", "min", "max", (end - F.col("_c")).alias("_start"), end.alias("_end"))
    pick = lambda r: F.max(F.when((F.col("_start") <= r) & (r < F.col("_end")), F.col(value)))
    picked = near.groupBy(*by, "n", "min", "max").agg(*[pick(r).alias(f"_{i}_{k}") for i, pair in enumerate(ranks) for k, r in zip("lh", pair)])
    q = [F.when(lo == hi, F.col(f"_{i}_l")).otherwise((hi - x) * F.col(f"_{i}_l") + (x - lo) * F.col(f"_{i}_h")) for i, (x, (lo, hi)) in enumerate(zip(at, ranks))]
    return picked.select(*by, "n", "min", "max", F.array(*q).alias("_q"))


def _of_steps(rows: DataFrame, steps: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of the steps given, with ``columns`` of those."""
    few = steps.select(*[F.col(c).alias(f"_{c}") for c in keys], *columns)
    return rows.join(few, same_keys(rows, few, keys)).drop(*[f"_{c}" for c in keys])


def _split(rows: DataFrame, steps: DataFrame, by: Sequence[str], value: str, wanted: Column, sums: Sequence[Column], until) -> tuple[DataFrame, DataFrame]:
    """The rows of the wanted steps, those of too full ones under parts of their range, and the parts that hold a wanted rank."""
    rows = _of_steps(rows, steps, [*by, "_step"], ["_before", "n", "min", "max", "_v", "_low", "_high"])
    parts = F.when(F.col("_v") > FULL, F.least(F.ceil(F.col("_v") * 4 / FULL), F.lit(PARTS))).otherwise(1)
    part = F.least(F.floor(F.try_divide(F.col(value) - F.col("_low"), F.col("_high") - F.col("_low")) * parts), parts - 1)
    rows = rows.withColumn("_part", F.coalesce(F.when(parts > 1, part), F.lit(0)).cast("long"))
    rows = stage(rows.withColumn("_old", F.col("_step")).withColumn("_step", F.concat_ws("/", "_old", "_part")).drop("_v", "_low", "_high"), "split")
    new = rows.groupBy(*by, "_old", "_part", "_step", "_before", "n", "min", "max").agg(*sums)
    start = F.col("_before") + F.coalesce(F.sum("_s").over(until([*by, "_old", "_part"])), F.lit(0))
    steps = stage(new.withColumn("_before", start).where(wanted).drop("_old", "_part"), "steps")
    return rows.drop("_old", "_part", "_before", "n", "min", "max"), steps


def first_values(df: DataFrame, by: Sequence[str], value: str, n: int) -> DataFrame:
    """by and _first: the ``n`` smallest different values of each group, in order."""
    distinct = df.where(F.col(value).isNotNull()).select(*by, value).distinct()
    few = distinct.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(value))).where(F.col("_r") <= n)
    return few.groupBy(*by).agg(F.sort_array(F.collect_list(value)).alias("_first"))  # n at most
