"""Reports on values: distributions, outlying sites, invalid values, semantic decisions, missingness, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .statistics import count_values, first_values, spread

BY = ["hospital_id", "variable"]
FENCED = ("min", "median", "iqr", "max", "range")


def distribution_summary(obs: DataFrame, min_non_null: int = 20) -> DataFrame:
    """Count, minimum, quartiles, maximum, IQR and range of each (hospital, variable) with enough values."""
    return summary_of(count_values(obs, BY, "value"), min_non_null)


def summary_of(counts: DataFrame, min_non_null: int = 20) -> DataFrame:
    out = spread(counts, BY, "value").where(F.col("n") >= min_non_null)
    out = out.select(*BY, "n", "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"), "max")
    return out.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn("range", F.col("max") - F.col("min"))


def numeric_summary(obs: DataFrame, examples: int = 10) -> DataFrame:
    """The distribution of each variable over all sites, however few its values, with its smallest different values as examples."""
    counts = count_values(obs, ["variable"], "value")
    out = spread(counts, ["variable"], "value").join(first_values(counts, ["variable"], "value", examples), "variable")
    shown = F.array_join(F.transform("_first", lambda x: F.format_string("%.4f", x)), ",")
    return out.select("variable", "n", "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"), "max", (F.col("_q")[2] - F.col("_q")[0]).alias("iqr"), shown.alias("examples"))


def distribution_issues(summary: DataFrame, min_hospitals: int = 4, fence: float = 1.5) -> DataFrame:
    """Hospitals whose metrics lie outside Tukey's fences over all hospitals of a variable: flagged_metrics, joined by commas."""
    long = summary.select(*BY, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("metric"), F.col(m).alias("x")) for i, m in enumerate(FENCED)])).alias("m")).select(*BY, "m.*")
    bounds = long.groupBy("variable", "metric").agg(F.count("*").alias("hospitals"), F.percentile("x", F.array(F.lit(0.25), F.lit(0.75))).alias("q")).where(F.col("hospitals") >= min_hospitals)
    width = F.col("q")[1] - F.col("q")[0]
    bounds = bounds.select("variable", "metric", "hospitals", (F.col("q")[0] - fence * width).alias("low"), (F.col("q")[1] + fence * width).alias("high"))
    out = long.join(bounds, ["variable", "metric"]).where("x < low OR x > high")
    return out.groupBy(*BY, "hospitals").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "metric"))), lambda x: x["metric"]), ",").alias("flagged_metrics"))


def rules_table(spark, rules: Sequence[tuple]) -> DataFrame:
    """Rules (variable, hard_min, hard_max, invalid_zero) as a table."""
    return spark.createDataFrame([tuple(r[:4]) for r in rules], "variable string, hard_min double, hard_max double, invalid_zero boolean")


def invalid(value: Column | str = "value") -> Column:
    """Whether a rule's row calls the value invalid; bounds themselves are valid."""
    v = F.col(value) if isinstance(value, str) else value
    return F.coalesce((v < F.col("hard_min")) | F.lit(False), F.lit(False)) | F.coalesce(v > F.col("hard_max"), F.lit(False)) | (F.coalesce(F.col("invalid_zero"), F.lit(False)) & F.coalesce(v == 0, F.lit(False)))


def clean_invalid(obs: DataFrame, rules: DataFrame) -> DataFrame:
    """Values that break their variable's rule become null. The rules are a few rows."""
    joined = obs.join(F.broadcast(rules), "variable", "left")
    return joined.withColumn("value", F.when(~invalid(), F.col("value"))).select(*obs.columns)


def invalid_value_qc(obs: DataFrame, rules: DataFrame, sites: DataFrame, examples: int = 10, concentrated_from: int = 5, concentrated_share: float = 0.5) -> DataFrame:
    """For every (site, rule), also without values: counts before and after, examples, and where a variable's invalid values gather."""
    judged = obs.join(F.broadcast(rules), "variable").select(*BY, "value", F.when(invalid(), F.col("value")).alias("_bad"))
    # each invalid value once; all valid ones of a group are one row
    per = stage(judged.groupBy(*BY, "_bad").agg(F.count("value").alias("_n")), "invalid-counts")
    counts = per.groupBy(*BY).agg(F.sum("_n").alias("_n"), F.sum(F.when(F.col("_bad").isNotNull(), F.col("_n")).otherwise(0)).alias("_bad")).join(first_values(per, BY, "_bad", examples), BY, "left")
    grid = sites.select("hospital_id").distinct().join(F.broadcast(rules.select("variable")))
    out = grid.join(counts, BY, "left").select(*BY, F.coalesce("_n", F.lit(0)).cast("long").alias("non_null_before"), F.coalesce("_bad", F.lit(0)).cast("long").alias("invalid_count"), F.array_join(F.transform("_first", lambda x: F.format_string("%.4f", x)), ",").alias("_text"))
    of_variable = Window.partitionBy("variable")
    total = F.sum("invalid_count").over(of_variable)
    first = F.first("hospital_id").over(of_variable.orderBy(F.desc("invalid_count"), "hospital_id"))
    out = out.withColumn("variable_total_invalid_count", total).withColumn("_first", first).withColumn("_most", F.max("invalid_count").over(of_variable))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    top = F.col("variable_total_invalid_count")
    return out.select(
        *BY, "non_null_before", (F.col("non_null_before") - F.col("invalid_count")).alias("non_null_after"), "invalid_count", share("invalid_count", "non_null_before").alias("invalid_proportion"),
        F.coalesce("_text", F.lit("")).alias("invalid_examples"), "variable_total_invalid_count", share("invalid_count", "variable_total_invalid_count").alias("site_share"),
        F.when(top > 0, F.col("_first")).alias("dominant_site"), share("_most", "variable_total_invalid_count").alias("dominant_share"),
        ((top >= concentrated_from) & (share("_most", "variable_total_invalid_count") >= concentrated_share)).alias("concentrated"),
    )


def apply_actions(obs: DataFrame, actions: DataFrame) -> DataFrame:
    """Site-specific actions (hospital_id, variable, action, factor): `divide` by the factor or `set_missing`. A few rows."""
    joined = obs.join(F.broadcast(actions), BY, "left")
    value = F.when(F.col("action") == "divide", F.col("value") / F.col("factor")).when(F.col("action") == "set_missing", F.lit(None)).otherwise(F.col("value"))
    return joined.withColumn("value", value).select(*obs.columns)


def semantic_decisions(obs: DataFrame, sites: DataFrame, actions: DataFrame, targets: Sequence[str], review: Sequence[str], min_non_null: int = 20, min_hospitals: int = 4, fence: float = 1.5) -> DataFrame:
    """A decision for every site and target variable, the first that applies: absent, a listed action, an unresolved meaning
    (``review`` variables), else kept. Medians before come from the distribution summary (so only with enough values), those after have no such gate."""
    # all of it from one count of values, before and after the actions
    counts = count_values(obs.where(F.col("variable").isin(list(targets))), BY, "value")
    summary = summary_of(counts, min_non_null)
    issues = distribution_issues(summary, min_hospitals, fence)
    before = counts.where("value IS NOT NULL").groupBy(*BY).agg(F.sum("_c").alias("_before"))
    after = spread(apply_actions(counts, actions), BY, "value", (0.5,)).select(*BY, F.col("n").alias("_after"), F.col("_q")[0].alias("median_after"))
    grid = sites.select("hospital_id").distinct().withColumn("variable", F.explode(F.array(*[F.lit(t) for t in targets])))
    out = grid.join(before, BY, "left").join(after, BY, "left").join(summary.select(*BY, F.col("median").alias("median_before")), BY, "left").join(issues.select(*BY, "flagged_metrics"), BY, "left").join(F.broadcast(actions), BY, "left")
    absent, action, open_ = F.coalesce("_before", F.lit(0)) == 0, F.col("action"), F.col("variable").isin(list(review))
    reciprocal = F.when(open_, F.try_divide(F.lit(1.0), F.col("median_before")))
    kind = F.when(absent, "no action needed").when(action == "divide", "unit conversion").when(action == "set_missing", "site-specific invalid variable").when(open_, "unresolved mismatch").otherwise("no action needed")
    applied = F.when(absent, "leave_missing").when(action.isNotNull(), action).when(open_, "keep_pending_review").otherwise("keep")
    advice = F.when(absent, "retain").when(action == "set_missing", "site_drop").when(action.isNull() & open_, "exclude").otherwise("retain")
    shown = lambda c: F.coalesce(F.format_string("%.3f", c), F.lit("NA"))
    median = F.when(F.col("median_before").isNull(), "NA").otherwise(shown(F.col("median_before")))
    evidence = F.when(absent, "no values").when(action.isNotNull(), F.concat(F.lit("median "), median)).when(open_, F.concat(F.lit("median "), median, F.lit(", reciprocal "), F.when(reciprocal.isNull(), "NA").otherwise(shown(reciprocal)))).when(F.col("flagged_metrics").isNotNull(), F.concat(F.lit("flagged: "), "flagged_metrics")).otherwise("none")
    return out.select(*BY, kind.alias("classification"), applied.alias("applied_action"), (~absent & action.isNull() & open_).alias("review_required"), advice.alias("recommendation"), F.coalesce("_before", F.lit(0)).cast("long").alias("non_null_before"), F.coalesce("_after", F.lit(0)).cast("long").alias("non_null_after"), "median_before", "median_after", reciprocal.alias("reciprocal_median_before"), F.coalesce("flagged_metrics", F.lit("")).alias("flagged_metrics_before"), evidence.alias("evidence"))


def non_numeric_issues(raw: DataFrame, examples: int = 10) -> DataFrame:
    """For raw text (hospital_id, column, canonical_name, text, plain, parsed): values that are no plain number, resolved by a parser or not."""
    odd = F.col("text").isNotNull() & F.col("plain").isNull()
    lost = odd & F.col("parsed").isNull()
    by = ["hospital_id", "column", "canonical_name"]
    # each lost text once; all other values of a group are one row
    per = stage(raw.groupBy(*by, F.when(lost, F.col("text")).alias("_lost")).agg(F.count("text").alias("_n"), F.count_if(odd).alias("_odd")), "text-counts")
    of_lost = F.sum(F.when(F.col("_lost").isNotNull(), F.col("_odd")).otherwise(0))
    out = per.groupBy(*by).agg(F.sum("_n").alias("non_null"), F.sum("_odd").alias("non_numeric"), (F.sum("_odd") - of_lost).alias("resolved"), of_lost.alias("unresolved")).where("non_numeric > 0")
    return out.join(first_values(per, by, "_lost", examples), by, "left").select(*by, "non_null", "non_numeric", "resolved", "unresolved", F.coalesce(F.array_join("_first", "|"), F.lit("")).alias("examples"))


def column_profile(df: DataFrame, examples: int = 8) -> DataFrame:
    """column, type, non_null, distinct values and the first few of them (as text) of each column."""
    types = dict(df.dtypes)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(c).cast("string").alias("v")) for c in df.columns])).alias("x")).select("x.*")
    per = stage(long.groupBy("column", "type", "v").agg(F.count("*").alias("n")), "column-counts")  # each value once, so distinct values need no set
    first = per.where("v IS NOT NULL").withColumn("_r", F.row_number().over(Window.partitionBy("column").orderBy("v"))).where(F.col("_r") <= examples)
    shown = first.groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("v")), "|").alias("examples"))
    out = per.groupBy("column", "type").agg(F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"), F.count("v").alias("distinct_values"))
    return out.join(shown, "column", "left")


def missingness_matrix(obs: DataFrame, sites: DataFrame, variables: Sequence[str]) -> DataFrame:
    """variable and, for each hospital, whether all its values are missing (long: hospital_id, variable, all_missing)."""
    n = obs.groupBy(*BY).agg(F.count("value").alias("_n"))
    grid = sites.select("hospital_id").distinct().withColumn("variable", F.explode(F.array(*[F.lit(v) for v in variables])))
    return grid.join(n, BY, "left").select(*BY, (F.coalesce("_n", F.lit(0)) == 0).alias("all_missing"))


def describe_by_hospital(obs: DataFrame) -> DataFrame:
    counts = count_values(obs, BY, "value")
    weigh = lambda x: F.sum(F.col("_c") * x)
    means = counts.groupBy(*BY).agg(F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("_c"))), F.lit(0)).alias("n"), weigh(F.col("value")).alias("_sum"))
    means = means.withColumn("mean", F.try_divide("_sum", "n"))
    away = counts.join(means.select(*BY, "mean"), BY).groupBy(*BY).agg(weigh((F.col("value") - F.col("mean")) ** 2).alias("_away"))
    out = means.join(away, BY).join(spread(counts, BY, "value").drop("n"), BY, "left")
    std = F.sqrt(F.try_divide(F.col("_away"), F.col("n") - 1))
    return out.select(*BY, "n", "mean", std.alias("std"), "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"), "max")


def time_coverage(obs: DataFrame) -> DataFrame:
    return obs.groupBy("hospital_id").agg(F.count("*").alias("rows"), F.countDistinct("stay_id_global").alias("stays"), F.min("time_us").alias("min_us"), F.max("time_us").alias("max_us"))


def schema_summary(obs: DataFrame, sites: DataFrame, variables: Sequence[str], rows: DataFrame | None = None) -> DataFrame:
    """Rows of each hospital (of ``rows``, by default the observations), number of variables and the names of those without any value."""
    n = (obs if rows is None else rows).groupBy("hospital_id").agg(F.count("*").alias("rows"))
    empty = missingness_matrix(obs, sites, variables).where("all_missing").groupBy("hospital_id").agg(F.array_join(F.sort_array(F.collect_list("variable")), ",").alias("_names"))  # names of variables
    out = sites.select("hospital_id").distinct().join(n, "hospital_id", "left").join(empty, "hospital_id", "left")
    return out.select("hospital_id", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.lit(len(variables)).cast("long").alias("columns"), F.coalesce("_names", F.lit("")).alias("all_missing"))


def crosstab(pairs: DataFrame, a: str, b: str, values: Sequence[str]) -> DataFrame:
    """Counts of each value of ``a`` by the given values of ``b``, 0 where there are none."""
    return pairs.groupBy(a).agg(*[F.count_if(F.col(b) == v).alias(f"{b}_{v}") for v in values])


def paired(obs: DataFrame, a: str, b: str) -> DataFrame:
    """hospital_id, a, b, n, has_a and has_b: how many source rows (hospital_id, row_ord) of the long form have each pair of values of two variables,
    and whether the row's export names them. Written; a row for each hospital and distinct pair."""
    value = lambda v: F.max(F.when(F.col("variable") == v, F.col("value")))
    rows = obs.where(F.col("variable").isin(a, b)).groupBy("hospital_id", "row_ord").agg(value(a).alias("a"), value(b).alias("b"), F.bool_or(F.col("variable") == a).alias("has_a"), F.bool_or(F.col("variable") == b).alias("has_b"))
    return stage(rows.groupBy("hospital_id", "a", "b").agg(F.count("*").alias("n"), F.bool_or("has_a").alias("has_a"), F.bool_or("has_b").alias("has_b")), "pairs")


def overlap_summary(pairs: DataFrame, sites: DataFrame, most: int = 10) -> DataFrame:
    """For every hospital of ``sites`` how two variables (`paired`) meet in a row: rows with each, with both, with the first at 1 or 0 and the
    second known, and the first ``most`` values of each."""
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    count = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    out = pairs.groupBy("hospital_id").agg(
        F.bool_or("has_a").alias("has_a"), F.bool_or("has_b").alias("has_b"), count(a.isNotNull()).alias("a_non_null"), count(b.isNotNull()).alias("b_non_null"),
        count(a.isNotNull() & b.isNotNull()).alias("both_non_null"), count((a == 1) & b.isNotNull()).alias("a1_b_non_null"), count((a == 0) & b.isNotNull()).alias("a0_b_non_null"),
    )
    for c in ("a", "b"):
        out = out.join(first_values(pairs, ["hospital_id"], c, most).withColumnRenamed("_first", f"{c}_values"), "hospital_id", "left")
    numbers = [c for c, t in out.dtypes if t == "bigint"]
    out = sites.select("hospital_id").distinct().join(out, "hospital_id", "left")
    none = F.array().cast("array<double>")
    return out.select("hospital_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("has_a", "has_b")], *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], *[F.coalesce(c, none).alias(c) for c in ("a_values", "b_values")])


def overlap_crosstab(pairs: DataFrame, most: int = 50) -> DataFrame:
    """hospital_id, a and a column for each value of b that occurs beside one of a (`paired`): the rows with both. More than ``most`` values are an error."""
    both = pairs.where("a IS NOT NULL AND b IS NOT NULL").withColumn("b", F.concat(F.lit("b_"), F.translate(F.format_string("%.2f", "b"), ".-", "_m")))
    values = [r[0] for r in both.select("b").distinct().orderBy("b").limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"more than {most} values to be columns")
    if not values:
        return both.select("hospital_id", "a").distinct()
    return both.groupBy("hospital_id", "a").pivot("b", values).agg(F.sum("n")).na.fill(0, values)


def artifact_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [t.agg(F.count("*").alias("rows")).select(F.lit(name).alias("artifact"), "rows") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_comparison(columns: DataFrame, reference: str) -> DataFrame:
    """Sites' columns (hospital_id, column) against a reference site's: what is missing, extra and common."""
    own = columns.groupBy("hospital_id").agg(F.sort_array(F.collect_set("column")).alias("own"))
    ref = own.where(F.col("hospital_id") == reference).select(F.col("own").alias("ref"))
    joined = own.join(F.broadcast(ref))
    text = lambda c: F.array_join(F.sort_array(c), ",")
    return joined.select("hospital_id", (F.col("own") == F.col("ref")).alias("same"), text(F.array_except("ref", "own")).alias("missing"), text(F.array_except("own", "ref")).alias("extra"), text(F.array_intersect("own", "ref")).alias("common"))


def translation_coverage(columns: DataFrame, known: DataFrame) -> DataFrame:
    """Raw columns (hospital_id, column) without a translation, and translations (column) that a hospital does not use."""
    k = known.select("column").distinct()
    unmapped = columns.distinct().join(F.broadcast(k), "column", "left_anti").select("hospital_id", "column", F.lit("unmapped").alias("state"))
    grid = columns.select("hospital_id").distinct().join(F.broadcast(k))
    unused = grid.join(columns, ["hospital_id", "column"], "left_anti").select("hospital_id", "column", F.lit("unused").alias("state"))
    return unmapped.unionByName(unused)
