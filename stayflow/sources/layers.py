"""Layers of written tables: CSV or Parquet, nested columns as JSON text in CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checks import require_none
from .raw import exists
from .staging import clear, shared_folder, stage  # noqa: F401

FORMATS = ("csv", "parquet")
# The tables of each layer by folder, as (file, table of `plans.layers`); what the last layer starts from.
HARMONIZED = {
    "static": [("harmonized", "static"), ("source_map", "static_source_map"), ("schema_summary", "static_schema_summary"), ("categorical_value_summary", "categorical_values"), ("unexpected_categories", "unexpected_categories")],
    "dynamic": [("harmonized", "dynamic"), ("wide", "dynamic_wide"), ("source_map", "dynamic_source_map"), ("schema_summary", "schema_summary"), ("non_numeric_issues", "non_numeric_issues"), ("semantic_decisions", "semantic_decisions"), ("invalid_value_rules", "invalid_value_rules"), ("invalid_value_qc", "invalid_value_qc"), ("distribution_summary", "distribution_summary"), ("distribution_issues", "distribution_issues")],
    "qc": [("stay_id_summary", "stay_id_summary"), ("stay_id_unique_stays_per_hospital", "unique_stays_per_hospital"), ("stay_id_local_id_collisions", "local_id_collisions"), ("stay_id_missing_id_values", "missing_id_rows"), ("stay_id_duplicate_static_global_ids", "static_duplicates"), ("stay_id_mapping_failures", "mapping_failures"), ("stay_id_duplicate_dynamic_time_index", "duplicate_time_rows"), ("mech_vent_ge_24h_stay_level", "vent_stay_level"), ("mech_vent_ge_24h_episode_level", "vent_episodes"), ("mech_vent_ge_24h_hospital_summary", "vent_hospital_summary"), ("mech_vent_ge_24h_failed_stays", "vent_failed_stays")],
}
STANDARDIZED = {
    "cohort": [("stay_level", "stay_level"), ("summary", "stay_summary"), ("icu_end_time_proxy_summary_by_hospital", "proxy_summary_by_hospital"), ("coding_distribution_by_hospital", "coding_distribution")],
    "blocked": [("asic_8h_block_index", "block_index"), ("asic_8h_blocked_dynamic_features", "blocked_features"), ("asic_8h_stay_block_counts", "stay_block_counts"), ("asic_8h_block_count_distribution_by_hospital", "block_count_distribution"), ("asic_8h_negative_dynamic_time_qc", "negative_time_qc"), ("asic_8h_validation", "block_validation"), ("asic_8h_qc_summary", "block_qc_summary"), ("asic_8h_example_stays", "example_stays")],
}
RESTRICTED = {"cohort": STANDARDIZED["cohort"] + [(n, n) for n in ("vital_group_coverage", "outcome_provenance", "site_eligibility", "site_counts", "stay_exclusions", "exclusion_summary_by_hospital", "attrition_by_hospital", "retained_hospitals", "retained_stays", "retained_table")], "blocked": STANDARDIZED["blocked"]}
MODEL_READY = {
    "cohort": [("chapter1_core_vital_group_coverage", "vital_group_coverage"), ("chapter1_site_eligibility", "site_eligibility"), ("chapter1_site_counts_summary", "site_counts"), ("chapter1_stay_exclusions", "stay_exclusions"), ("chapter1_stay_exclusion_summary_by_hospital", "exclusion_summary_by_hospital"), ("chapter1_counts_by_hospital", "attrition_by_hospital"), ("chapter1_retained_hospitals", "retained_hospitals"), ("chapter1_retained_stays", "retained_stays"), ("chapter1_retained_stay_table", "retained_table")],
    "instances": [("chapter1_candidate_instances", "candidate_instances"), ("chapter1_valid_instances", "valid_instances"), ("chapter1_instance_counts_by_horizon", "instance_counts"), ("chapter1_instance_exclusion_summary", "instance_exclusions")],
    "labels": [("chapter1_terminal_icu_mortality_labels", "labels"), ("chapter1_terminal_icu_mortality_usable_labels", "usable_labels"), ("chapter1_terminal_icu_mortality_label_summary_by_horizon", "label_summary")],
    "model_ready": [("chapter1_feature_set", "feature_set"), ("chapter1_model_ready_dataset", "model_ready"), ("chapter1_readiness_summary", "readiness_summary"), ("chapter1_feature_availability_by_horizon", "feature_availability")],
}
MODEL_INPUTS = ["static/harmonized", "dynamic/harmonized", "blocked/asic_8h_block_index", "blocked/asic_8h_blocked_dynamic_features", "blocked/asic_8h_stay_block_counts"]
MODEL_OPTIONAL = ["cohort/stay_level"]
#: The order of each table that is not by ORDER: its columns, "-" before those that fall. The table's contract, wherever it is written.
ORDERS = {
    "static_source_map": ("canonical_name", "hospital_id"), "dynamic_source_map": ("canonical_name", "hospital_id"), "categorical_values": ("variable", "hospital_id", "code"), "unexpected_categories": ("column", "hospital_id", "value"),
    "semantic_decisions": ("variable", "hospital_id"), "invalid_value_rules": ("variable",), "invalid_value_qc": ("variable", "hospital_id"), "distribution_summary": ("variable", "hospital_id"), "distribution_issues": ("variable", "hospital_id"),
    "non_numeric_issues": ("-unresolved", "-non_numeric", "hospital_id", "column"), "local_id_collisions": ("stay_id_local", "hospital_id", "stay_id_global"), "missing_id_rows": ("-source", "hospital_id", "stay_id_local"),
    "static_duplicates": ("stay_id_global", "hospital_id", "stay_id_local"), "duplicate_time_rows": ("stay_id_global", "time_us", "hospital_id", "row_ord"), "mapping_failures": ("row_ord",), "vent_episodes": ("hospital_id", "stay_id_global", "episode"),
    "coding_distribution": ("hospital_id", "variable", "code"), "block_count_distribution": ("hospital_id", "block_count"), "vital_group_coverage": ("hospital_id", "-required", "physiologic_group"),
    "instance_exclusions": ("horizon_h", "-n", "exclusion_reason"), "instance_counts": ("horizon_h",), "label_summary": ("horizon_h",), "feature_availability": ("horizon_h", "feature"),
    "stay_id_summary": (), "stay_summary": (), "block_qc_summary": (), "readiness_summary": (), "site_counts": (), "feature_set": (), "example_stays": (),
}
#: Columns that order all other tables, the first ones of these that a table has.
ORDER = ("hospital_id", "stay_id_global", "block_index", "horizon_h", "time_us", "row_ord", "variable", "metric", "column", "canonical_name", "feature", "code", "value")


def as_set(name: str) -> Column:
    """An array column without an order of its own: written sorted. Other arrays are lists, whose order is kept."""
    return F.col(f"`{name}`").alias(name, metadata={"set": True})


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for formats without nesting: lists in their order, sets (`as_set`) sorted."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and f.metadata.get("set"):
            c = F.to_json(F.sort_array(c))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def ordered(df: DataFrame, name: str | None = None) -> DataFrame:
    """Sorted as ORDERS says for a table of that name, else by the columns of ORDER that it has; nulls last: one range partitioning, at the sink only."""
    keys = ORDERS.get(name) if name in ORDERS else [c for c in ORDER if c in df.columns and isinstance(df.schema[c].dataType, T.AtomicType)]
    by = [F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys]
    return df.orderBy(*by) if by else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}; known: {', '.join(FORMATS)}")
    writer = (flat(df) if fmt == "csv" else df).write.mode(mode).partitionBy(*partition_by)
    writer.csv(path, header=True, escape='"') if fmt == "csv" else writer.parquet(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Further part files of a CSV table. Each part file of Spark's has the header, which `read_table` takes from every one; the columns must be the table's."""
    spark = df.sparkSession
    if exists(spark, path):
        have = read_table(spark, path).columns
        if have != df.columns:
            raise ValueError(f"columns {df.columns} are not those of {path}: {have}")
    write_table(df, path, "csv", "append")


def read_table(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A table by the extension of its path; CSV as text unless a schema is given."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True).option("escape", '"')
        return (reader.schema(schema) if schema else reader).csv(path)
    raise ValueError(f"{path} is neither .csv nor .parquet")


def write_layer(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", mode: str = "errorifexists", layout: Mapping[str, Sequence[tuple[str, str]]] | None = None) -> list[str]:
    """Write named tables below a folder, each in its order; the paths written.

    layout: the folders and files of a layer, all of which must be there; without it every table goes by its own name.
    """
    files = {f"{group}/{file}": name for group, pairs in layout.items() for file, name in pairs} if layout else {n: n for n in tables}
    missing = sorted(set(files.values()) - set(tables))
    if missing:
        raise KeyError(f"the layer lacks tables {missing}")
    for file, name in files.items():
        write_table(ordered(tables[name], name), f"{folder}/{file}.{fmt}", fmt, mode)
    return [f"{folder}/{file}.{fmt}" for file in files]


def load_layer(spark: SparkSession, folder: str, required: Sequence[str] = MODEL_INPUTS, optional: Sequence[str] = MODEL_OPTIONAL, fmt: str = "parquet", schemas: Mapping[str, str | T.StructType] | None = None) -> dict[str, DataFrame]:
    """The tables of a layer (by default what the model-ready layer starts from); all that are missing are named in one error."""
    path = {n: f"{folder}/{n}.{fmt}" for n in [*required, *optional]}
    found = {n for n, p in path.items() if exists(spark, p)}
    missing = [path[n] for n in required if n not in found]
    if missing:
        raise FileNotFoundError(f"missing tables: {', '.join(missing)}")
    return {n: read_table(spark, path[n], (schemas or {}).get(n)) for n in path if n in found}


def known_rows(dynamic: DataFrame, static: DataFrame) -> DataFrame:
    """The observations of known stays; a null hospital is an error."""
    require_none(dynamic.where("hospital_id IS NULL"), "rows without a hospital")
    return dynamic.join(static.select("stay_id_global").distinct(), "stay_id_global", "left_semi")


def write_dynamic_by_hospital(dynamic: DataFrame, static: DataFrame, path: str, replace: bool = False) -> None:
    """The rows of known stays, a folder a hospital; a null hospital is an error.

    replace: rewrite the hospitals that ``dynamic`` has, and leave the folders of all others as they are.
    """
    writer = known_rows(dynamic, static).write.partitionBy("hospital_id")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path) if replace else writer.parquet(path)


#: Buckets of a table that is kept by stay, and the column that deals them.
BUCKETS, BUCKET_KEY = 64, "stay_id_global"


def save_by_stay(df: DataFrame, table: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` as a table of the session's catalog, dealt into buckets by stay and sorted inside them, and read back.

    Tables with the same number of buckets are joined and grouped by stay without a shuffle; ``buckets`` should leave some 200 MB to each
    (2^16 for 10 TB). The table lies in the warehouse, which a cluster shares.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, BUCKET_KEY)  # a file a bucket
    dealt.write.bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY).mode("overwrite").format("parquet").saveAsTable(table)
    return spark.table(table)


def replace_hospitals(df: DataFrame, table: str) -> None:
    """Write the rows of ``df`` over those of its hospitals in a catalog table that is partitioned by hospital and dealt into buckets by stay."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def save_layer_by_stay(static: DataFrame, dynamic: DataFrame, database: str, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """The harmonized tables kept by stay in a database: static in buckets, the observations of known stays also by hospital.

    What is rebuilt from them groups and joins observations by stay where they lie; `replace_hospitals` rewrites one hospital alone.
    """
    spark = static.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    save_by_stay(static, f"{database}.static", buckets)
    rows = known_rows(dynamic, static).repartition(buckets, BUCKET_KEY)
    rows.write.partitionBy("hospital_id").bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY).mode("overwrite").format("parquet").saveAsTable(f"{database}.dynamic")
    return {name: spark.table(f"{database}.{name}") for name in ("static", "dynamic")}
