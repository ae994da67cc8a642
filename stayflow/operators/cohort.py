"""Restriction to sites and stays, with every step counted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import HOUR_US
from .blocks import metrics
from .checks import require_columns, require_none

MIN_GROUPS = 3


def dynamic_presence(obs: DataFrame) -> DataFrame:
    """Rows of each (hospital, stay), from observations or from `blocks.stay_facts`."""
    n = F.sum("n_rows") if "n_rows" in obs.columns else F.count("*")
    out = obs.where("stay_id_global IS NOT NULL").groupBy("hospital_id", "stay_id_global").agg(n.alias("dynamic_row_count"))
    return out.withColumn("has_dynamic_data", F.col("dynamic_row_count") > 0)


def group_table(spark, groups: Mapping[str, Sequence[str]], optional: Sequence[str] = ()) -> DataFrame:
    rows = [(g, v, i, g not in optional) for g, vs in groups.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "physiologic_group string, variable string, _at int, required boolean")


def vital_group_coverage(sites: DataFrame, obs: DataFrame, groups: DataFrame) -> DataFrame:
    """For every hospital and group of variables: which of them have values, and how many (from observations or `blocks.stay_facts`)."""
    n = obs.groupBy("hospital_id", "variable").agg((F.sum("n_values") if "n_values" in obs.columns else F.count("value")).alias("_n"))
    grid = sites.select("hospital_id").distinct().join(F.broadcast(groups)).join(n, ["hospital_id", "variable"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    row = F.sort_array(F.collect_list(F.struct("_at", "variable", "_n")))
    out = grid.groupBy("hospital_id", "physiologic_group", "required").agg(row.alias("_v"))
    names = lambda c: F.array_join(F.transform(c, lambda x: x["variable"]), ",")
    used = F.filter("_v", lambda x: x["_n"] > 0)
    counts = F.array_join(F.transform("_v", lambda x: F.concat(x["variable"], F.lit("="), x["_n"].cast("string"))), ",")
    return out.select("hospital_id", "physiologic_group", "required", names(F.col("_v")).alias("candidates"), names(used).alias("satisfied_by"), (F.size(used) > 0).alias("group_usable"), counts.alias("non_null_counts"))


def outcome_provenance(static: DataFrame, source_map: DataFrame | None = None, raw: DataFrame | None = None) -> DataFrame:
    """How each hospital's outcome came about.

    source_map: `harmonize.source_map`, which says whether a hospital has a source column; raw: hospital_id and raw_outcome, one row a
    raw row. Status, the first that holds: harmonized values; no raw table to look at; no source column; a source column without
    a value; else values that harmonization lost, which `check_provenance` raises on.
    """
    out = static.groupBy("hospital_id").agg(F.count("icu_mortality").alias("harmonized_non_null"))
    have, n, seen = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(False)
    if source_map is not None:
        out = out.join(source_map.where("canonical_name = 'icu_mortality'").select("hospital_id", "raw_columns"), "hospital_id", "left")
        have = F.coalesce("raw_columns", F.lit(""))
    if raw is not None:
        out = out.join(raw.groupBy("hospital_id").agg(F.count("raw_outcome").alias("raw_non_null")), "hospital_id", "left")
        n, seen = F.col("raw_non_null"), F.col("raw_non_null").isNotNull()
    status = (
        F.when(F.col("harmonized_non_null") > 0, "verified_non_missing_harmonized_icu_mortality").when(~seen, "raw_source_verification_not_available")
        .when(F.coalesce(have, F.lit("")) == "", "verified_no_raw_icu_mortality_source_column").when(n == 0, "verified_raw_icu_mortality_source_present_but_all_missing").otherwise(LOST)
    )
    return out.select("hospital_id", "harmonized_non_null", n.alias("raw_non_null"), status.alias("status"))


LOST = "raw_values_lost"


def check_provenance(provenance: DataFrame) -> None:
    require_none(provenance.where(F.col("status") == LOST), "outcomes were lost in harmonization")


def site_eligibility(stays: DataFrame, obs: DataFrame, groups: DataFrame, min_groups: int = MIN_GROUPS, provenance: DataFrame | None = None) -> DataFrame:
    """A hospital needs an outcome and enough of the required groups. ``obs`` may be `blocks.stay_facts`.

    Besides the counts: for each group of ``groups`` (a few rows) the array of variables that satisfy it, the reasons as an array and as
    text, and where `outcome_provenance` is given how the outcome came about.
    """
    require_columns(stays, ["hospital_id", "stay_id_global", "icu_mortality"], "stays")
    present = dynamic_presence(obs).select("hospital_id", "stay_id_global", F.lit(1).alias("_has"))
    codes = F.array_join(F.sort_array(F.collect_set("icu_mortality")), ",")
    site = stays.join(present, ["hospital_id", "stay_id_global"], "left").groupBy("hospital_id").agg(F.count("*").alias("site_stay_count"), F.countDistinct(F.when(F.col("_has") == 1, F.col("stay_id_global"))).alias("stays_with_dynamic_data"), F.count("icu_mortality").alias("outcome_non_null"), codes.alias("outcome_codes"))
    names = sorted(r[0] for r in groups.select("physiologic_group").distinct().collect())
    satisfied = F.filter(F.split("satisfied_by", ","), lambda v: v != "")
    of_group = [F.first(F.when(F.col("physiologic_group") == g, satisfied), ignorenulls=True).alias(f"{g}_satisfied_by") for g in names]
    missing = F.sort_array(F.collect_list(F.when(F.col("required") & ~F.col("group_usable"), F.col("physiologic_group"))))  # a few groups
    usable = vital_group_coverage(stays, obs, groups).groupBy("hospital_id").agg(F.count_if(F.col("required") & F.col("group_usable")).alias("usable_groups"), F.array_join(missing, ",").alias("missing_groups"), *of_group)
    out = site.join(usable, "hospital_id", "left")
    if provenance is not None:
        out = out.join(provenance.select("hospital_id", F.col("status").alias("outcome_status")), "hospital_id", "left")
    has_outcome, enough = F.col("outcome_non_null") > 0, F.coalesce("usable_groups", F.lit(0)) >= min_groups
    reasons = F.array_compact(F.array(F.when(~has_outcome, "missing/unusable icu_mortality"), F.when(~enough, "insufficient core-vitals coverage")))
    return out.select("*", has_outcome.alias("outcome_available"), enough.alias("core_vitals_eligible"), (has_outcome & enough).alias("site_included"), reasons.alias("exclusion_reasons"), F.array_join(reasons, "; ").alias("exclusion_reason"))


def site_counts(sites: DataFrame) -> DataFrame:
    return metrics(sites.agg(F.count("*").alias("hospitals_before"), F.count_if("site_included").alias("hospitals_after"), F.count_if(~F.col("site_included")).alias("hospitals_excluded")))


def stay_exclusions(stays: DataFrame, obs: DataFrame, sites: DataFrame) -> DataFrame:
    """Each stay through the cascade: site, observations, readmission known, readmission not flagged. ``obs`` may be `blocks.stay_facts`.

    The reasons of its site and its own are arrays, and text; a stay of an excluded site has none of its own.
    """
    require_columns(stays, ["hospital_id", "stay_id_global", "readmission", "icu_mortality", "icu_end_time_proxy_hours"], "stays")
    present = dynamic_presence(obs).groupBy("stay_id_global").agg(F.sum("dynamic_row_count").alias("dynamic_row_count"))
    out = stays.join(F.broadcast(sites.select("hospital_id", "site_included", F.col("exclusion_reasons").alias("site_exclusion_reasons"))), "hospital_id", "left").join(present, "stay_id_global", "left")
    out = out.withColumn("site_included", F.coalesce("site_included", F.lit(False))).withColumn("dynamic_row_count", F.coalesce("dynamic_row_count", F.lit(0)).cast("long"))
    inside, none = F.col("site_included"), F.array().cast("array<string>")
    first = inside & F.coalesce(F.col("readmission") == 0, F.lit(False))
    out = out.select(
        "hospital_id", "stay_id_global", "readmission", "icu_mortality", "icu_end_time_proxy_hours", "dynamic_row_count", (F.col("dynamic_row_count") > 0).alias("has_dynamic_data"), first.alias("first_stay_proxy_eligible"),
        F.coalesce("site_exclusion_reasons", none).alias("site_exclusion_reasons"), (~inside).alias("exclude_site"), (inside & (F.col("dynamic_row_count") == 0)).alias("exclude_no_data"),
        (inside & F.col("readmission").isNull()).alias("exclude_missing_readmission"), (inside & F.coalesce(F.col("readmission") == 1, F.lit(False))).alias("exclude_readmission"),
    )
    out = out.withColumn("after_site", ~F.col("exclude_site")).withColumn("after_no_data", F.expr("after_site AND NOT exclude_no_data")).withColumn("after_missing_readmission", F.expr("after_no_data AND NOT exclude_missing_readmission")).withColumn("retained", F.expr("after_missing_readmission AND NOT exclude_readmission"))
    reasons = F.array_compact(F.array(F.when(F.col("exclude_no_data"), "no dynamic data"), F.when(F.col("exclude_missing_readmission"), "missing readmission"), F.when(F.col("exclude_readmission"), "readmission flagged")))
    status = F.when(F.col("exclude_site"), "excluded_site").when(F.size(reasons) > 0, "excluded_stay").otherwise("retained")
    return out.withColumns({"stay_exclusion_reasons": reasons, "exclusion_reason": F.array_join(reasons, "; "), "site_exclusion_reason": F.array_join("site_exclusion_reasons", "; "), "status": status})


def attrition_by_hospital(exclusions: DataFrame) -> DataFrame:
    steps = ["after_site", "after_no_data", "after_missing_readmission", "retained"]
    return exclusions.groupBy("hospital_id").agg(F.count("*").alias("before"), *[F.count_if(s).alias(s) for s in steps])


def exclusion_summary_by_hospital(exclusions: DataFrame) -> DataFrame:
    steps = ["exclude_site", "exclude_no_data", "exclude_missing_readmission", "exclude_readmission"]
    return exclusions.groupBy("hospital_id").agg(F.count("*").alias("stays"), *[F.count_if(s).alias(s) for s in steps], F.count_if("retained").alias("retained"))


def retained_stays(exclusions: DataFrame) -> DataFrame:
    return exclusions.where("retained").select("hospital_id", "stay_id_global", "readmission", "icu_mortality", "icu_end_time_proxy_hours")


def retained_hospitals(exclusions: DataFrame) -> DataFrame:
    return exclusions.where("retained").groupBy("hospital_id").agg(F.count("*").alias("retained_stays"))


def check_cohort(retained: DataFrame, exclusions: DataFrame, sites: DataFrame) -> None:
    """Raise if a retained stay is twice there, of an excluded site, without data, or without a known first stay."""
    require_none(retained.groupBy("stay_id_global").count().where("count > 1 OR stay_id_global IS NULL"), "retained stays are not unique")
    outside = sites.where("NOT site_included").select("hospital_id")
    require_none(retained.join(F.broadcast(outside), "hospital_id", "left_semi"), "retained stays of excluded hospitals")
    require_none(exclusions.where("retained AND (dynamic_row_count = 0 OR readmission IS NULL OR readmission = 1)"), "retained stays that a step excludes")


def with_block_counts(static: DataFrame, counts: DataFrame) -> DataFrame:
    """The harmonized static rows with the end and the blocks of their stays; a stay named twice is an error."""
    require_none(static.groupBy("stay_id_global").count().where("count > 1"), "stays are not unique")
    ends = counts.select("stay_id_global", "icu_end_us", "block_count")
    return static.join(ends, "stay_id_global", "left").withColumn("icu_end_time_proxy_hours", F.col("icu_end_us") / HOUR_US)
