"""Stay level and fixed blocks of hours.

Observations are long: hospital_id, stay_id_global, time_us (since admission), row_ord, variable, value. Blocks are half-open and
full: a stay has as many as fit before its last observation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import HOUR_US
from ..plans import fixed
from .checks import require_columns, require_none
from .statistics import count_values, first_values, spread

BLOCK_H = 8
BLOCK_US = BLOCK_H * HOUR_US
STATISTICS = ("obs_count", "mean", "median", "min", "max", "last")
BLOCK_KEYS = ["hospital_id", "stay_id_global", "block_index"]


def end_time_proxy(obs: DataFrame) -> DataFrame:
    """The last observed time of each stay."""
    return obs.where("stay_id_global IS NOT NULL AND time_us IS NOT NULL").groupBy("stay_id_global").agg(F.max("time_us").alias("icu_end_us"))


def stay_facts(obs: DataFrame) -> DataFrame:
    """hospital_id, stay_id_global, variable, n_rows, n_values and last_us: one pass over the observations for ends, presence and coverage."""
    require_columns(obs, ["hospital_id", "stay_id_global", "time_us", "variable", "value"], "observations")
    return obs.groupBy("hospital_id", "stay_id_global", "variable").agg(F.count("*").alias("n_rows"), F.count("value").alias("n_values"), F.max("time_us").alias("last_us"))


def ends_of(facts: DataFrame) -> DataFrame:
    """`end_time_proxy` from `stay_facts`."""
    return facts.where("stay_id_global IS NOT NULL AND last_us IS NOT NULL").groupBy("stay_id_global").agg(F.max("last_us").alias("icu_end_us"))


def stay_level(static: DataFrame, ends: DataFrame) -> DataFrame:
    """One row a stay of the static table with its end; a stay named twice is an error found by `check_stay_level`."""
    require_columns(static, ["hospital_id", "stay_id_global", "icu_mortality", "icu_readmit"], "static")
    require_columns(ends, ["stay_id_global", "icu_end_us"], "ends")
    stays = static.select("hospital_id", "stay_id_global", F.col("icu_readmit").alias("readmission"), "icu_mortality", F.lit(0).cast("long").alias("icu_admission_us"))
    return stays.join(ends, "stay_id_global", "left").withColumn("icu_end_time_proxy_hours", F.col("icu_end_us") / HOUR_US)


def check_stay_level(static: DataFrame) -> None:
    require_none(static.groupBy("stay_id_global").count().where("count > 1 OR stay_id_global IS NULL"), "stays are not unique")


def metrics(one_row: DataFrame) -> DataFrame:
    """The columns of a one-row table as rows metric, value."""
    pairs = ", ".join(f"'{c}', cast(`{c}` AS double)" for c in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) AS (metric, value)")


def stay_summary(stays: DataFrame) -> DataFrame:
    """The five counts of the stay level with what they mean."""
    n = [F.count("*"), F.countDistinct("stay_id_global"), F.count("icu_end_us"), F.count_if(F.col("icu_end_us").isNull()), F.lit(1)]
    notes = F.create_map(*[F.lit(x) for pair in fixed.SUMMARY_NOTES.items() for x in pair])
    return metrics(stays.agg(*[c.alias(m) for c, m in zip(n, fixed.SUMMARY_NOTES)])).withColumn("note", F.element_at(notes, F.col("metric")))


def proxy_summary_by_hospital(stays: DataFrame) -> DataFrame:
    h = F.col("icu_end_time_proxy_hours")
    counts = count_values(stays, ["hospital_id"], "icu_end_time_proxy_hours")
    known = F.sum(F.when(h.isNotNull(), F.col("_c")).otherwise(0))
    out = counts.groupBy("hospital_id").agg(F.sum("_c").alias("stays"), known.alias("with_end"), (F.sum("_c") - known).alias("without_end"), F.sum(h * F.col("_c")).alias("_sum"))
    out = out.join(spread(counts, ["hospital_id"], "icu_end_time_proxy_hours", (0.5,)).drop("n"), "hospital_id", "left")
    return out.select("hospital_id", "stays", "with_end", "without_end", F.col("min").alias("min_h"), F.try_divide("_sum", "with_end").alias("mean_h"), F.col("_q")[0].alias("median_h"), F.col("max").alias("max_h"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """hospital_id, variable, code, n and share of the hospital's rows; nulls are a code of their own."""
    long = df.select("hospital_id", F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("code")) for c in columns])).alias("x")).select("hospital_id", "x.*")
    counts = long.groupBy("hospital_id", "variable", "code").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("hospital_id", "variable")))


def stay_block_counts(stays: DataFrame) -> DataFrame:
    """Full blocks of each stay; none for a stay without an end or with one before admission."""
    require_columns(stays, ["hospital_id", "stay_id_global", "icu_end_us"], "stays")
    end = F.when(F.col("icu_end_us") >= 0, F.col("icu_end_us"))
    n = F.coalesce(F.expr(f"icu_end_us DIV {BLOCK_US}L"), F.lit(0))  # whole numbers: a double can't hold every microsecond
    n = F.when(end.isNotNull(), n).otherwise(F.lit(0)).cast("long")
    return stays.select("hospital_id", "stay_id_global", "icu_end_us", n.alias("block_count"), (n > 0).alias("has_block"), F.coalesce((end > 0) & (end % BLOCK_US == 0), F.lit(False)).alias("ends_on_boundary"), (n * BLOCK_H).alias("terminal_block_end_h"))


def block_index(counts: DataFrame) -> DataFrame:
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.col("block_count") - 1)).alias("block_index")
    blocks = counts.where("block_count >= 1").select("hospital_id", "stay_id_global", k)
    return blocks.select("*", (F.col("block_index") * BLOCK_H).alias("block_start_h"), ((F.col("block_index") + 1) * BLOCK_H).alias("block_end_h"), ((F.col("block_index") + 1) * BLOCK_H).alias("prediction_time_h"))


def in_blocks(obs: DataFrame, counts: DataFrame) -> DataFrame:
    """Observations of known stays inside a full block, with its index."""
    require_columns(obs, ["hospital_id", "stay_id_global", "time_us", "row_ord", "variable", "value"], "observations")
    known = counts.select("hospital_id", "stay_id_global", "block_count")
    bucket = F.expr(f"time_us DIV {BLOCK_US}L")
    return obs.where("time_us >= 0").withColumn("block_index", bucket).join(known, ["hospital_id", "stay_id_global"]).where("block_index < block_count").drop("block_count")


def blocked_features_long(obs: DataFrame, counts: DataFrame) -> DataFrame:
    """Statistics of each (stay, block, variable) with a value; `last` is by time, then row order."""
    return features_long(in_blocks(obs, counts))


def features_long(placed: DataFrame) -> DataFrame:
    return placed.where("value IS NOT NULL").groupBy(*BLOCK_KEYS, "variable").agg(
        F.count("*").alias("obs_count"), F.avg("value").alias("mean"), F.median("value").alias("median"), F.min("value").alias("min"), F.max("value").alias("max"), F.max_by("value", F.struct("time_us", "row_ord")).alias("last")
    )


def blocked_features(placed: DataFrame, counts: DataFrame, variables: Sequence[str], statistics: Sequence[str] = STATISTICS) -> DataFrame:
    """One row a block, empty ones too: counts 0, statistics null where a variable has no value. ``placed`` (`in_blocks`) is read twice, so write it first."""
    long = features_long(placed.where(F.col("variable").isin(list(variables))))
    wide = [F.max(F.when(F.col("variable") == v, F.col(s))).alias(f"{v}_{s}") for v in variables for s in statistics]
    features = long.groupBy(*BLOCK_KEYS).agg(F.sum("obs_count").alias("_values"), F.count("*").alias("_variables"), *wide)
    rows = placed.groupBy(*BLOCK_KEYS).agg(F.count_distinct("row_ord").alias("_rows"))
    out = block_index(counts).join(rows, BLOCK_KEYS, "left").join(features, BLOCK_KEYS, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    stats = [zero(f"{v}_{s}").alias(f"{v}_{s}") if s == "obs_count" else F.col(f"{v}_{s}") for v in variables for s in statistics]
    return out.select(*BLOCK_KEYS, "block_start_h", "block_end_h", "prediction_time_h", zero("_rows").alias("dynamic_row_count"), zero("_values").alias("non_missing_measurements_in_block"), zero("_variables").alias("observed_variables_in_block"), *stats)


def negative_time_qc(obs: DataFrame, examples: int = 5) -> DataFrame:
    """Stays with rows before admission: how many, and the first times."""
    by = ["hospital_id", "stay_id_global"]
    times = obs.where("time_us < 0").groupBy(*by, "time_us").agg(F.count("*").alias("_c"))
    out = times.groupBy(*by).agg(F.sum("_c").alias("rows"), F.min("time_us").alias("min_us"), F.max("time_us").alias("max_us"))
    return out.join(first_values(times, by, "time_us", examples), by).select(*by, "rows", "min_us", "max_us", F.col("_first").alias("examples"))


def block_validation(counts: DataFrame, index: DataFrame) -> DataFrame:
    """Each stay's blocks against its count and end; `ok` is true where all agree."""
    made = index.groupBy("hospital_id", "stay_id_global").agg(F.count("*").alias("generated"), F.max("block_end_h").alias("max_end_h"), F.bool_and(F.col("prediction_time_h") == F.col("block_end_h")).alias("_at_end"))
    out = counts.join(made, ["hospital_id", "stay_id_global"], "left")
    generated = F.coalesce("generated", F.lit(0)).cast("long")
    ok = (generated == F.col("block_count")) & (F.coalesce("max_end_h", F.lit(0)) == F.col("terminal_block_end_h")) & F.coalesce("_at_end", F.lit(True)) & ((F.col("block_count") == 0) | (F.col("max_end_h") * HOUR_US <= F.col("icu_end_us")))
    return out.select("hospital_id", "stay_id_global", "block_count", generated.alias("generated"), "max_end_h", "terminal_block_end_h", ok.alias("ok"))


def check_blocks(validation: DataFrame) -> None:
    require_none(validation.where("NOT ok"), "blocks disagree with their stays")


def block_count_distribution(counts: DataFrame) -> DataFrame:
    n = counts.groupBy("hospital_id", "block_count").agg(F.count("*").alias("stays"))
    return n.withColumn("share", F.col("stays") / F.sum("stays").over(Window.partitionBy("hospital_id")))


def block_qc_summary(counts: DataFrame, validation: DataFrame, known_obs: DataFrame) -> DataFrame:
    """The size of blocks, stays and rows that went in, blocks that came out, and whether their ends agree with the stays' (1 or 0).

    known_obs: the observations of the stays in ``counts``.
    """
    stays = counts.agg(
        F.lit(BLOCK_H).alias("block_size_hours"), F.count("*").alias("stays_total"), F.count_if(~F.col("has_block")).alias("stays_with_zero_blocks"), F.count_if("has_block").alias("stays_with_one_or_more_blocks"),
        F.count_if("ends_on_boundary").alias("stays_ending_exactly_on_8h_boundary"), F.lit(1).alias("block_index_is_generic_pre_analytic_structure"),
    )
    end = F.col("icu_end_us")
    all_of = lambda c: F.coalesce(F.bool_and(c), F.lit(True)).cast("int")
    joined = validation.join(counts.select("hospital_id", "stay_id_global", end.alias("icu_end_us"), "ends_on_boundary"), ["hospital_id", "stay_id_global"])
    ends = joined.agg(
        F.coalesce(F.sum("generated"), F.lit(0)).alias("block_rows_total"),
        all_of((F.col("generated") == 0) | (F.col("max_end_h") * HOUR_US <= end)).alias("all_constructed_blocks_end_on_or_before_icu_end_time_proxy"),
        all_of(~F.col("ends_on_boundary") | (F.col("terminal_block_end_h") * HOUR_US == end)).alias("exact_boundary_stays_have_terminal_block_end_equal_proxy"),
    )
    per_stay = known_obs.groupBy("stay_id_global").agg(F.count("*").alias("_n"), F.count_if(F.col("time_us") < 0).alias("_negative"))
    rows = per_stay.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("dynamic_rows_total"), F.coalesce(F.sum("_negative"), F.lit(0)).alias("negative_dynamic_time_rows_in_input"), F.count_if(F.col("_negative") > 0).alias("negative_dynamic_time_stays_in_input"))
    return metrics(stays).unionByName(metrics(ends)).unionByName(metrics(rows))


def known_rows(obs: DataFrame, stays: DataFrame) -> DataFrame:
    """The observations of the stays given."""
    return obs.join(stays.select("hospital_id", "stay_id_global"), ["hospital_id", "stay_id_global"], "left_semi")


def example_stays(counts: DataFrame, want: int = 5) -> DataFrame:
    """Up to ``want`` stays that show the kinds, with their blocks: none, ends on a boundary, one, several, most.

    Each kind in turn takes its first stay that no earlier kind took (by blocks, hospital and stay; of the most blocks the longest stay); the list is
    then filled up in that order. Only the first ``want`` stays of each kind can matter, which bounds what the selection looks at.
    """
    n = F.col("block_count")
    kinds = [("zero_blocks", n == 0), ("exact_8h_boundary", F.col("ends_on_boundary")), ("single_block", n == 1), ("multiple_blocks", n >= 2), ("max_block_count", F.lit(True)), ("additional_example", F.lit(True))]
    first = counts.select("hospital_id", "stay_id_global", "icu_end_us", "block_count", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, (_, c) in enumerate(kinds)]))).alias("k"))
    largest = F.col("k") == 4
    order = [F.when(largest, -n).otherwise(n), F.when(largest, -F.coalesce("icu_end_us", F.lit(-1))).otherwise(F.lit(0)), "hospital_id", "stay_id_global"]
    first = first.withColumn("_r", F.row_number().over(Window.partitionBy("k").orderBy(*order))).where(F.col("_r") <= want)
    taken: dict[str, tuple] = {}
    rows = first.orderBy("k", "_r").collect()  # want rows of each kind at most
    for i, (name, _) in enumerate(kinds):
        for r in (r for r in rows if r["k"] == i):
            if r["stay_id_global"] not in taken and len(taken) < want:
                taken[r["stay_id_global"]] = (name, r["hospital_id"], r["stay_id_global"], r["icu_end_us"], r["block_count"])
                if i < 5:
                    break
    chosen = counts.sparkSession.createDataFrame(list(taken.values()), "example_type string, hospital_id string, stay_id_global string, icu_end_us long, block_count long")
    bounds = block_index(chosen).select("stay_id_global", F.struct("block_start_h", interval_label(F.col("block_start_h"), F.col("block_end_h")).alias("t")).alias("x"))
    text = bounds.groupBy("stay_id_global").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["t"]), ", ").alias("block_boundaries"))
    out = chosen.join(text, "stay_id_global", "left")
    return out.select("example_type", "hospital_id", "stay_id_global", (F.col("icu_end_us") / HOUR_US).alias("icu_end_time_proxy_hours"), "block_count", F.coalesce("block_boundaries", F.lit("")).alias("block_boundaries"))


def interval_label(start: Column, end: Column) -> Column:
    return F.format_string("[%d, %d)", start, end)
