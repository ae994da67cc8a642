"""Reports on the identity of stays: reused, missing, repeated and unmatched ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import metrics
from .checks import require_columns

#: Metric, and what stands for it in the error of `check_stay_ids` (None where any value is good).
METRICS = {
    "static_rows_total": None,
    "static_unique_stay_id_global_total": None,
    "unique_stays_hospital_count": None,
    "duplicated_stay_id_local_values_across_hospitals": None,
    "failed_or_missing_static_dynamic_mappings": "observations without their stay",
    "rows_missing_hospital_id_or_stay_id_local": "rows without an id",
    "duplicate_static_stay_id_global_rows": "repeated stays",
    "duplicate_dynamic_rows_within_stay_time": "repeated times",
}


def unique_stays_per_hospital(static: DataFrame, obs: DataFrame | None = None) -> DataFrame:
    """The different stays of each hospital in the tables given; with observations, also those of the static table alone (static_stays)."""
    part = lambda df, of_static: df.select("hospital_id", "stay_id_global", F.lit(of_static).alias("_static"))
    ids = part(static, True) if obs is None else part(static, True).unionByName(part(obs, False))
    counts = [F.count("stay_id_global").alias("stays")]
    if obs is not None:
        counts.append(F.count_if(F.col("_static") & F.col("stay_id_global").isNotNull()).alias("static_stays"))
    return ids.groupBy("hospital_id", "stay_id_global").agg(F.bool_or("_static").alias("_static")).groupBy("hospital_id").agg(*counts)


def local_id_collisions(static: DataFrame) -> DataFrame:
    """The stays of local ids, null too, that several hospitals use: stay_id_local, hospital_id, stay_id_global and the number of hospitals."""
    ids = static.select("stay_id_local", "hospital_id", "stay_id_global").distinct()
    many = ids.groupBy(F.col("stay_id_local").alias("_l")).agg(F.countDistinct("hospital_id").alias("hospitals")).where("hospitals > 1")
    return ids.join(many, ids["stay_id_local"].eqNullSafe(F.col("_l"))).drop("_l")


def _no_id() -> Column:
    return F.col("hospital_id").isNull() | F.col("stay_id_local").isNull()


def missing_id_rows(static: DataFrame, obs: DataFrame) -> DataFrame:
    """Rows without a hospital or a local id, of both tables, with the time of an observation."""
    part = lambda df, name, time: df.where(_no_id()).select(F.lit(name).alias("source"), "hospital_id", "stay_id_local", "stay_id_global", time.alias("time_us"))
    return part(static, "static", F.lit(None).cast("long")).unionByName(part(obs, "dynamic", F.col("time_us")))


def static_duplicates(static: DataFrame) -> DataFrame:
    n = F.count("*").over(Window.partitionBy("stay_id_global"))
    return static.where("stay_id_global IS NOT NULL").withColumn("duplicate_count", n).where("duplicate_count > 1").select("hospital_id", "stay_id_local", "stay_id_global", "duplicate_count")


def _judged(static: DataFrame, obs: DataFrame) -> DataFrame:
    """The observations with the reason (null: none) why they do not map to one stay of the static table by (hospital, local id), nulls being equal."""
    require_columns(static, ["hospital_id", "stay_id_local", "stay_id_global"], "static")
    keys = static.groupBy(F.col("hospital_id").alias("_h"), F.col("stay_id_local").alias("_l")).agg(F.count("*").alias("_rows"), F.countDistinct("stay_id_global").alias("_ids"), F.min("stay_id_global").alias("_global"))
    joined = obs.join(keys, obs["hospital_id"].eqNullSafe(F.col("_h")) & obs["stay_id_local"].eqNullSafe(F.col("_l")), "left")
    reason = F.when(F.col("_rows").isNull(), "missing_static_match").when((F.col("_rows") != 1) | (F.col("_ids") != 1), "ambiguous_static_mapping").when(F.col("_global") != F.col("stay_id_global"), "mismatched_stay_id_global")
    return joined.withColumn("reason", reason)


def mapping_failures(static: DataFrame, obs: DataFrame) -> DataFrame:
    """Observations that do not map to one stay, each with the first reason that holds."""
    return _judged(static, obs).where("reason IS NOT NULL").select("row_ord", "hospital_id", "stay_id_local", "stay_id_global", "time_us", "reason")


def duplicate_time_rows(obs: DataFrame) -> DataFrame:
    """Rows that share their stay and time, nulls being equal. Counted first and joined back, so rows without both are no one task's."""
    require_columns(obs, ["stay_id_global", "time_us"], "observations")
    n = obs.groupBy(F.col("stay_id_global").alias("_s"), F.col("time_us").alias("_t")).agg(F.count("*").alias("duplicate_count")).where("duplicate_count > 1")
    joined = obs.join(n, obs["stay_id_global"].eqNullSafe(F.col("_s")) & obs["time_us"].eqNullSafe(F.col("_t")))
    return joined.select("row_ord", "hospital_id", "stay_id_global", "time_us", "duplicate_count")


def totals(static: DataFrame, obs: DataFrame) -> DataFrame:
    """One row with the eight METRICS.

    The observations are read once: each row is judged against its static key, then rows of one stay and time are added up, and the three
    counts of observations are sums over those.
    """
    zero = F.lit(0)
    ids = static.groupBy("hospital_id", "stay_id_local", "stay_id_global").agg(F.count("*").alias("n"))
    plain = ids.agg(F.coalesce(F.sum("n"), zero).alias("rows"), F.countDistinct("stay_id_global").alias("stays"), F.countDistinct("hospital_id").alias("hospitals"), F.coalesce(F.sum(F.when(_no_id(), F.col("n"))), zero).alias("static_without"))
    reused = ids.where("stay_id_local IS NOT NULL").groupBy("stay_id_local").agg(F.countDistinct("hospital_id").alias("h")).agg(F.count_if(F.col("h") > 1).alias("reused"))
    repeated = ids.where("stay_id_global IS NOT NULL").groupBy("stay_id_global").agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), zero).alias("repeated"))
    times = _judged(static, obs).groupBy("stay_id_global", "time_us").agg(F.count("*").alias("n"), F.count_if(_no_id()).alias("without"), F.count("reason").alias("failed"))
    seen = times.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("without", "failed")], F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), zero).alias("again"))
    one = plain.join(F.broadcast(reused)).join(F.broadcast(repeated)).join(F.broadcast(seen))  # a row each
    values = ["rows", "stays", "hospitals", "reused", "failed", F.col("static_without") + F.col("without"), "repeated", "again"]
    return one.select(*[(F.col(v) if isinstance(v, str) else v).alias(m) for v, m in zip(values, METRICS)])


def stay_id_summary(static: DataFrame, obs: DataFrame) -> DataFrame:
    return metrics(totals(static, obs))


def check_stay_ids(static: DataFrame, obs: DataFrame, examples: int = 5) -> None:
    """Raise one error that names every failure, with examples: missing ids, repeated stays, unmatched observations, repeated times."""
    found = totals(static, obs).first().asDict()
    reports = {
        "rows_missing_hospital_id_or_stay_id_local": lambda: missing_id_rows(static, obs), "duplicate_static_stay_id_global_rows": lambda: static_duplicates(static),
        "failed_or_missing_static_dynamic_mappings": lambda: mapping_failures(static, obs), "duplicate_dynamic_rows_within_stay_time": lambda: duplicate_time_rows(obs),
    }
    bad = [f"{METRICS[m]} ({found[m]}): {[r.asDict() for r in report().limit(examples).collect()]}" for m, report in reports.items() if found[m]]
    if bad:
        raise ValueError("stay ids: " + "; ".join(bad))
