"""Prediction instances, labels and the model-ready table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_KEYS, STATISTICS, metrics

HORIZONS = (8, 24)
# Name and meaning of the label.
LABEL_NAME = "terminal_icu_mortality"
LABEL_SEMANTICS = "Stay-level ICU mortality reused across horizons; true event-time horizon labels are not available in the standardized ASIC artifacts."


def feature_columns(features: DataFrame, variables: Sequence[str], statistics: Sequence[str] = STATISTICS) -> list[str]:
    """The selected feature columns that the table has, in order."""
    return [f"{v}_{s}" for v in variables for s in statistics if f"{v}_{s}" in features.columns]


def feature_set(spark, features: DataFrame, variables: Sequence[str], statistics: Sequence[str] = STATISTICS) -> DataFrame:
    have = set(feature_columns(features, variables, statistics))
    return spark.createDataFrame([(f"{v}_{s}", v, s, f"{v}_{s}" in have) for v in variables for s in statistics], "feature string, variable string, statistic string, selected boolean")


def candidate_instances(retained: DataFrame, features: DataFrame, variables: Sequence[str], horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Every block of a retained stay with every horizon; valid if the block has values and the stay lasts to the horizon's end."""
    counts = [c for c in feature_columns(features, variables) if c.endswith("_obs_count")]
    n = sum((F.coalesce(F.col(c), F.lit(0)) for c in counts), F.lit(0)).cast("long")
    stays = retained.select("hospital_id", "stay_id_global", "icu_end_time_proxy_hours")
    blocks = features.select(*BLOCK_KEYS, "block_start_h", "block_end_h", "prediction_time_h", n.alias("feature_obs_count")).join(stays, ["hospital_id", "stay_id_global"])
    out = blocks.withColumn("horizon_h", F.explode(F.array(*[F.lit(h).cast("long") for h in horizons])))
    end = F.col("prediction_time_h") + F.col("horizon_h")
    has, full = F.col("feature_obs_count") > 0, F.coalesce(F.col("icu_end_time_proxy_hours") >= end, F.lit(False))
    name = F.concat("stay_id_global", F.lit("__b"), F.col("block_index").cast("string"), F.lit("__h"), F.col("horizon_h").cast("string"))
    reason = F.when(~has, "no_chapter1_feature_data_in_block").when(~full, "insufficient_future_followup")
    return out.select(
        name.alias("instance_id"), *BLOCK_KEYS, "block_start_h", "block_end_h", "prediction_time_h", "horizon_h", end.alias("future_window_end_h"), "icu_end_time_proxy_hours", "feature_obs_count",
        has.alias("has_feature_data_in_block"), full.alias("has_full_future_horizon"), (has & full).alias("valid_instance"), reason.alias("exclusion_reason"),
    )


def valid_instances(candidates: DataFrame) -> DataFrame:
    return candidates.where("valid_instance").drop("valid_instance", "exclusion_reason")


def instance_counts(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("horizon_h").agg(F.count("*").alias("candidates"), F.count_if("valid_instance").alias("valid"), F.count_if(~F.col("valid_instance")).alias("excluded"))


def instance_exclusions(candidates: DataFrame) -> DataFrame:
    return candidates.where("NOT valid_instance").groupBy("horizon_h", "exclusion_reason").agg(F.count("*").alias("n"))


def labels(valid: DataFrame, retained: DataFrame) -> DataFrame:
    """The valid instances with their stay's outcome, whatever the horizon, and what the label is."""
    outcome = retained.select("hospital_id", "stay_id_global", F.col("icu_mortality").alias("label_value"))
    out = valid.join(outcome, ["hospital_id", "stay_id_global"], "left")
    return out.withColumns({"label_available": F.col("label_value").isNotNull(), "label_name": F.lit(LABEL_NAME), "label_semantics": F.lit(LABEL_SEMANTICS)})


def usable_labels(all_labels: DataFrame) -> DataFrame:
    return all_labels.where("label_available").drop("label_available")


def label_summary(all_labels: DataFrame) -> DataFrame:
    v = F.col("label_value")
    return all_labels.groupBy("horizon_h").agg(F.count("*").alias("valid"), F.count(v).alias("labelled"), F.count_if(v == 1).alias("positive"), F.count_if(v == 0).alias("negative"), F.count_if(v.isNull()).alias("missing"))


def model_ready(usable: DataFrame, features: DataFrame, selected: Sequence[str]) -> DataFrame:
    keys = [*BLOCK_KEYS, "block_start_h", "block_end_h", "prediction_time_h"]
    return usable.select(*keys, "instance_id", "horizon_h", "label_value").join(features.select(*keys, *selected), keys, "left")


def readiness_summary(ready: DataFrame, selected: Sequence[str]) -> DataFrame:
    return metrics(ready.agg(F.count("*").alias("rows"), F.lit(len(selected)).alias("selected_features"), F.countDistinct("horizon_h").alias("horizons")))


def feature_availability(ready: DataFrame, selected: Sequence[str]) -> DataFrame:
    """Values present of each feature at each horizon: one pass, a column a feature, then turned to rows."""
    counts = ready.groupBy("horizon_h").agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in selected])
    long = counts.select("horizon_h", "rows", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("non_missing")) for c in selected])).alias("x"))
    return long.select("horizon_h", "x.feature", "x.non_missing", "rows", F.try_divide(F.col("x.non_missing"), F.col("rows")).alias("share"))
