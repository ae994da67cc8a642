"""The layers from raw exports to a model-ready table, each a dictionary of DataFrames, and their writers.

What many tables of a layer are made from (raw text, static, long dynamic, blocks) is written once to the shared folder; the rest is lazy.
Every layer checks what its reference does before anything is written: aliases, stay ids, times, blocks, provenance, the cohort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import blocks, cohort, harmonize, identity, instances, quality, ventilation
from ..sources import layers as sinks
from ..sources import raw
from ..sources.staging import stage
from . import fixed


def identity_mapping(section: str) -> dict[str, list[str]]:
    return {name: [name] for name in fixed.raw_columns(section)}


def harmonized(spark: SparkSession, root: str, min_non_null: int = 20, min_hospitals: int = 4, fence: float = 1.5, check: bool = True, translation: str | None = None) -> dict[str, DataFrame]:
    """Raw exports to canonical static and dynamic tables (wide and long) with their reports; checks aliases, the stays' ids and times.

    translation: the path of a translation file, in place of the built-in one.
    """
    sections = raw.read_translation(spark, translation) if translation else {}
    exports = {kind: raw.load_sites(spark, root, kind) for kind in ("static", "dynamic")}
    text_static, text_dynamic = (stage(raw.load_all(spark, root, kind, sections.get(kind), of), f"raw-{kind}") for kind, of in exports.items())
    site = F.col("hospital_id")
    static = stage(harmonize.harmonize_static(text_static, site, identity_mapping("static")), "static")
    variables = [c for c in fixed.dynamic_columns() if c not in fixed.TEXT_COLUMNS]
    rows = stage(harmonize.dynamic_rows(text_dynamic, site, identity_mapping("dynamic")), "dynamic-rows")
    long = stage(harmonize.harmonize_dynamic_long(text_dynamic, site, identity_mapping("dynamic"), cleaned=True), "dynamic-long")
    actions = spark.createDataFrame(fixed.SEMANTIC_ACTIONS, "hospital_id string, variable string, action string, factor double")
    rules = quality.rules_table(spark, fixed.INVALID_VALUE_RULES)
    acted = quality.apply_actions(long, actions)
    clean = stage(quality.clean_invalid(acted, rules).where("value IS NOT NULL"), "dynamic")
    if check:
        identity.check_stay_ids(static, rows)
        ventilation.check_identity(static)
        ventilation.check_times(clean, fixed.SUPPORT_MARKERS)
    times = stage(ventilation.supported_times(clean, fixed.SUPPORT_MARKERS), "vent-times")
    found = ventilation.episodes(times)
    stays = stage(ventilation.stay_qc(static, times, found), "vent-stays")
    summary = stage(quality.distribution_summary(clean, min_non_null), "distribution")
    text, name = F.col("text"), F.col("canonical_name")
    values = raw.values_of(exports["dynamic"], sections.get("dynamic")).withColumns({"plain": X.number(text), "parsed": harmonize.numeric_value(text, name, site)})
    static_columns, dynamic_columns = (raw.columns_of(of) for of in exports.values())
    names = [c for c in fixed.STATIC_COLUMNS if c != "hospital_id"]
    static_long = static.select("hospital_id", F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in names])).alias("x")).select("hospital_id", "x.*")
    return {
        "static": static, "dynamic": clean, "dynamic_wide": harmonize.to_wide(clean, variables),
        "unexpected_categories": harmonize.unexpected_categories(text_static, site, identity_mapping("static")),
        "categorical_values": blocks.value_counts(static, ["sex", "bmi_group", "hosp_mortality", "icu_mortality"]),
        "static_source_map": harmonize.source_map(static_columns, fixed.raw_columns("static", sections.get("static"))),
        "static_schema_summary": quality.schema_summary(static_long, static, names, rows=static),
        "dynamic_source_map": harmonize.source_map(dynamic_columns, fixed.raw_columns("dynamic", sections.get("dynamic"))),
        "schema_summary": quality.schema_summary(clean, static, variables, rows=rows),
        "non_numeric_issues": quality.non_numeric_issues(values),
        "semantic_decisions": quality.semantic_decisions(long, static, actions, fixed.SEMANTIC_TARGETS, fixed.SEMANTIC_REVIEW, min_non_null, min_hospitals, fence),
        "invalid_value_rules": rules, "invalid_value_qc": quality.invalid_value_qc(acted, rules, static),
        "distribution_summary": summary, "distribution_issues": quality.distribution_issues(summary, min_hospitals, fence),
        "stay_id_summary": identity.stay_id_summary(static, rows), "unique_stays_per_hospital": identity.unique_stays_per_hospital(static), "local_id_collisions": identity.local_id_collisions(static),
        "missing_id_rows": identity.missing_id_rows(static, rows), "static_duplicates": identity.static_duplicates(static), "mapping_failures": identity.mapping_failures(static, rows), "duplicate_time_rows": identity.duplicate_time_rows(rows),
        "vent_episodes": found, "vent_stay_level": stays, "vent_hospital_summary": ventilation.hospital_summary(stays), "vent_failed_stays": ventilation.failed_stays(stays),
    }


def standardized(static: DataFrame, dynamic: DataFrame, variables: Sequence[str] = fixed.MODEL_VARIABLES, check: bool = True) -> dict[str, DataFrame]:
    """Stay level and blocks of a harmonized static table and long dynamic table."""
    if check:
        blocks.check_stay_level(static)
    stays = stage(blocks.stay_level(static, blocks.end_time_proxy(dynamic)), "stay-level")
    return stay_tables(stays) | blocked(stays, dynamic, variables, check)


def stay_tables(stays: DataFrame) -> dict[str, DataFrame]:
    return {
        "stay_level": stays, "stay_summary": blocks.stay_summary(stays), "proxy_summary_by_hospital": blocks.proxy_summary_by_hospital(stays), "coding_distribution": blocks.value_counts(stays, ["readmission", "icu_mortality"]),
    }


def blocked(stays: DataFrame, dynamic: DataFrame, variables: Sequence[str] = fixed.MODEL_VARIABLES, check: bool = True) -> dict[str, DataFrame]:
    """The blocks of the stays given: all of them, or those of a restricted cohort (hospital_id, stay_id_global, icu_end_us)."""
    counts = stage(blocks.stay_block_counts(stays), "block-counts")
    index = blocks.block_index(counts)
    validation = blocks.block_validation(counts, index)
    if check:
        blocks.check_blocks(validation)
    known = blocks.known_rows(dynamic, counts)
    features = blocks.blocked_features(stage(blocks.in_blocks(dynamic, counts), "in-blocks"), counts, variables)
    return {
        "stay_block_counts": counts, "block_index": index, "blocked_features": features, "negative_time_qc": blocks.negative_time_qc(known), "block_validation": validation,
        "block_count_distribution": blocks.block_count_distribution(counts), "block_qc_summary": blocks.block_qc_summary(counts, validation, known), "example_stays": blocks.example_stays(counts),
    }


def restricted(static: DataFrame, stays: DataFrame, dynamic: DataFrame, min_groups: int = cohort.MIN_GROUPS, provenance: DataFrame | None = None, check: bool = True) -> dict[str, DataFrame]:
    """Sites and stays that remain, with every step counted. provenance: `cohort.outcome_provenance`, which an error status stops."""
    if check and provenance is not None:
        cohort.check_provenance(provenance)
    facts = stage(blocks.stay_facts(dynamic), "facts")
    groups = cohort.group_table(stays.sparkSession, fixed.VITAL_GROUPS, fixed.OPTIONAL_GROUPS)
    sites = stage(cohort.site_eligibility(stays, facts, groups, min_groups, provenance), "sites")
    exclusions = stage(cohort.stay_exclusions(stays, facts, sites), "exclusions")
    retained = cohort.retained_stays(exclusions)
    if check:
        cohort.check_cohort(retained, exclusions, sites)
    table = cohort.with_block_counts(static, blocks.stay_block_counts(stays)).join(retained.select("stay_id_global"), "stay_id_global", "left_semi")
    tables = {
        "vital_group_coverage": cohort.vital_group_coverage(stays, facts, groups), "site_eligibility": sites, "site_counts": cohort.site_counts(sites), "stay_exclusions": exclusions,
        "attrition_by_hospital": cohort.attrition_by_hospital(exclusions), "exclusion_summary_by_hospital": cohort.exclusion_summary_by_hospital(exclusions), "retained_stays": retained, "retained_hospitals": cohort.retained_hospitals(exclusions), "retained_table": table,
    }
    return tables | stay_tables(stays) | ({} if provenance is None else {"outcome_provenance": provenance})


def restricted_blocks(retained: DataFrame, stays: DataFrame, dynamic: DataFrame, variables: Sequence[str] = fixed.MODEL_VARIABLES) -> dict[str, DataFrame]:
    """The blocks of the restricted cohort alone."""
    return blocked(stays.join(retained.select("stay_id_global"), "stay_id_global", "left_semi"), dynamic, variables)


def model_ready(static: DataFrame, stays: DataFrame, dynamic: DataFrame, features: DataFrame, variables: Sequence[str] = fixed.MODEL_VARIABLES, horizons: Sequence[int] = instances.HORIZONS, min_groups: int = cohort.MIN_GROUPS) -> dict[str, DataFrame]:
    """Cohort, instances, labels and the model-ready table."""
    tables = restricted(static, stays, dynamic, min_groups)
    features = stage(features, "features")
    candidates = stage(instances.candidate_instances(tables["retained_stays"], features, variables, horizons), "candidates")
    valid = instances.valid_instances(candidates)
    labels = instances.labels(valid, tables["retained_stays"])
    usable = instances.usable_labels(labels)
    selected = instances.feature_columns(features, variables)
    ready = instances.model_ready(usable, features, selected)
    return tables | {
        "candidate_instances": candidates, "valid_instances": valid, "instance_counts": instances.instance_counts(candidates), "instance_exclusions": instances.instance_exclusions(candidates),
        "labels": labels, "usable_labels": usable, "label_summary": instances.label_summary(labels),
        "feature_set": instances.feature_set(stays.sparkSession, features, variables), "model_ready": ready, "readiness_summary": instances.readiness_summary(ready, selected), "feature_availability": instances.feature_availability(ready, selected),
    }


def write_harmonized(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> list[str]:
    return sinks.write_layer(tables, folder, fmt, layout=sinks.HARMONIZED)


def write_standardized(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> list[str]:
    return sinks.write_layer(tables, folder, fmt, layout=sinks.STANDARDIZED)


def write_restricted(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> list[str]:
    return sinks.write_layer(tables, folder, fmt, layout=sinks.RESTRICTED)


def write_model_ready(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> list[str]:
    return sinks.write_layer(tables, folder, fmt, layout=sinks.MODEL_READY)


def rebuild_standardized(spark: SparkSession, folder: str, fmt: str = "csv", variables: Sequence[str] = fixed.MODEL_VARIABLES) -> dict[str, DataFrame]:
    """The standardized layer from a written harmonized one; equal to the direct build."""
    found = sinks.load_layer(spark, folder, ["static/harmonized", "dynamic/harmonized"], (), fmt, {"static/harmonized": STATIC_SCHEMA, "dynamic/harmonized": DYNAMIC_SCHEMA})
    return standardized(found["static/harmonized"], found["dynamic/harmonized"], variables)


def rebuild_standardized_by_stay(spark: SparkSession, database: str, variables: Sequence[str] = fixed.MODEL_VARIABLES) -> dict[str, DataFrame]:
    """The same from tables kept by stay (`sources.layers.save_layer_by_stay`): observations are grouped and joined in the buckets they lie in.

    Lets the session's joins use a partitioning by some of their keys, as the buckets are by stay and most joins by hospital and stay.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return standardized(spark.table(f"{database}.static"), spark.table(f"{database}.dynamic"), variables)


#: Schemas of the harmonized tables, for formats without types.
STATIC_SCHEMA = ", ".join(f"`{c}` {'long' if c in fixed.STATIC_NUMBERS else 'string'}" for c in fixed.STATIC_COLUMNS)
DYNAMIC_SCHEMA = "hospital_id string, stay_id_global string, stay_id_local string, time_us long, row_ord long, variable string, value double"
