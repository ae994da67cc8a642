"""The registered queries and their SQL: every operator on the whole test tables through the bindings' views."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import blocks as B
from ..operators import cohort as C
from ..operators import harmonize as H
from ..operators import identity as I
from ..operators import instances as P
from ..operators import quality as Q
from ..operators import ventilation as V
from ..sources.layers import stage
from . import bindings as b
from . import fixed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
SELECTED = [f"{v}_{s}" for v in b.VARIABLES for s in B.STATISTICS]
ROUNDED = {"double": 6}


def register(name: str, sql: str | None) -> Callable[[Query], Query]:
    """Register a query; doubles are rounded, as engines differ in their last digits."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


@lru_cache(maxsize=1)
def oracle_sql() -> dict[str, str]:
    base = b.base_sql()
    # a query's own WITH goes on with the views'
    return {name: f"WITH RECURSIVE {base}, {sql.lstrip().removeprefix('WITH ').removeprefix('RECURSIVE ')}" if sql.lstrip().startswith("WITH ") else f"WITH {base} {sql}" for name, sql in SQL.items()}


def r(*columns: str) -> str:
    """SQL for columns rounded to six digits."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _facts(s, d):
    """What ends, presence and coverage need of the observations, in one read of them; written, as several tables start from it."""
    return stage(B.stay_facts(b.cohort_obs(s, d)), "facts")


def _settled(df, *columns):
    """Means rounded to nine digits first: a tie at the sixth is one in both engines, whatever the order of their sums."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


def _static_harmonized(s, d):
    return H.harmonize_static(b.raw_static(s, d).drop("Pseudo-ID"), F.col("hospital_id"))


def _stays(s, d, facts=None):
    return B.stay_level(b.static(s, d), B.end_time_proxy(b.obs(s, d)) if facts is None else B.ends_of(facts))


def _counts(s, d, facts=None):
    return B.stay_block_counts(_stays(s, d, facts))


def _features(s, d, facts=None):
    counts = stage(_counts(s, d, facts), "counts")
    return B.blocked_features(stage(B.in_blocks(b.obs(s, d), counts), "placed"), counts, b.VARIABLES)


def _validation(s, d):
    counts = _counts(s, d)
    return B.block_validation(counts, B.block_index(counts))


def _block_qc(s, d):
    counts = stage(_counts(s, d), "counts")
    return B.block_qc_summary(counts, B.block_validation(counts, B.block_index(counts)), B.known_rows(b.obs(s, d), counts))


def _groups(s):
    return C.group_table(s, b.GROUPS)


def _sites(s, d, facts=None):
    facts = _facts(s, d) if facts is None else facts
    return C.site_eligibility(_stays(s, d, facts), facts, _groups(s))


def _exclusions(s, d, facts=None):
    facts = _facts(s, d) if facts is None else facts
    return C.stay_exclusions(_stays(s, d, facts), facts, _sites(s, d, facts))


def _listed(df):
    """Arrays as JSON text, which compares alike in both engines."""
    return df.select(*[F.to_json(c).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


def _provenance(s, d):
    """Sites of every kind: without a source column (3), with an empty one (5), without a raw table (6), with values that were lost (7)."""
    site = F.col("hospital_id")
    static = b.static(s, d).withColumn("icu_mortality", F.when(~site.isin("site_3", "site_5", "site_6", "site_7"), F.col("icu_mortality"))).withColumn("raw_outcome", F.when(site != "site_5", F.col("raw_outcome")))
    columns = static.where(site != "site_3").select("hospital_id", F.lit("raw_outcome").alias("column"))
    return C.outcome_provenance(static, H.source_map(columns, OUTCOMES), static.where(site != "site_6").select("hospital_id", "raw_outcome"))


def _instances(s, d):
    """Retained stays, features and candidate instances; events are read twice, for the facts and for the blocks."""
    facts = _facts(s, d)
    retained = stage(C.retained_stays(_exclusions(s, d, facts)), "retained")
    features = stage(_features(s, d, facts), "features")
    return retained, features, P.candidate_instances(retained, features, b.VARIABLES)


def _candidates(s, d):
    return _instances(s, d)[2]


def _labels(s, d):
    retained, _, candidates = _instances(s, d)
    return P.labels(P.valid_instances(candidates), retained)


def _ready(s, d):
    retained, features, candidates = _instances(s, d)
    return P.model_ready(P.usable_labels(P.labels(P.valid_instances(candidates), retained)), features, SELECTED)


def _times(s, d):
    return V.supported_times(b.obs(s, d), b.MARKERS)


def _episodes(s, d):
    return V.episodes(_times(s, d))


def _vent(s, d):
    times = stage(_times(s, d), "times")
    return V.stay_qc(b.static(s, d), times, V.episodes(times))


def _rules(s):
    return Q.rules_table(s, b.RULES)


def _actions(s):
    return s.createDataFrame(b.ACTIONS, "hospital_id string, variable string, action string, factor double")


def _long_lineitem(s, d):
    """A second long table, many values for few groups: line items by supplier."""
    x = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"l_{v}").alias("value")) for v in ("quantity", "extendedprice", "discount", "tax")]))
    return b.table(s, d, "lineitem").select(b.site("l_suppkey").alias("hospital_id"), x.alias("x")).select("hospital_id", "x.variable", "x.value")


# stay level and blocks

register("end_time_proxy", "SELECT * FROM proxy")(lambda s, d: B.end_time_proxy(b.obs(s, d)))
register("stay_level", f"SELECT hospital_id, stay_id_global, readmission, icu_mortality, icu_admission_us, icu_end_us, {r('icu_end_time_proxy_hours')} FROM stays")(_stays)
register("stay_summary", """SELECT unnest(['rows', 'unique_stays', 'with_end', 'without_end', 'icu_end_time_proxy_is_recording_extent_proxy']) AS metric,
    unnest([CAST(count(*) AS DOUBLE), count(DISTINCT stay_id_global), count(icu_end_us), count(*) - count(icu_end_us), 1]) AS value, unnest([""" + ", ".join(f"'{n}'" for n in fixed.SUMMARY_NOTES.values()) + "]) AS note FROM stays")(lambda s, d: B.stay_summary(_stays(s, d)))  # fmt: skip
register("proxy_summary_by_hospital", """SELECT hospital_id, count(*) AS stays, count(icu_end_us) AS with_end, count(*) - count(icu_end_us) AS without_end, round(min(icu_end_time_proxy_hours), 6) AS min_h,
    round(round(avg(icu_end_time_proxy_hours), 9), 6) AS mean_h, round(median(icu_end_time_proxy_hours), 6) AS median_h, round(max(icu_end_time_proxy_hours), 6) AS max_h FROM stays GROUP BY 1""")(lambda s, d: _settled(B.proxy_summary_by_hospital(stage(_stays(s, d), "stays")), "mean_h"))  # fmt: skip
register("coding_distribution", """SELECT hospital_id, variable, code, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY hospital_id, variable), 6) AS share FROM
    (SELECT hospital_id, 'readmission' AS variable, CAST(readmission AS VARCHAR) AS code FROM stays UNION ALL SELECT hospital_id, 'icu_mortality', CAST(icu_mortality AS VARCHAR) FROM stays) GROUP BY hospital_id, variable, code""")(lambda s, d: B.value_counts(_stays(s, d), ["readmission", "icu_mortality"]))  # fmt: skip
register("stay_block_counts", """SELECT *, block_count > 0 AS has_block, coalesce(icu_end_us > 0 AND icu_end_us % 28800000000 = 0, false) AS ends_on_boundary, block_count * 8 AS terminal_block_end_h FROM counts""")(_counts)
register("block_index", "SELECT *, block_index * 8 AS block_start_h, block_index * 8 + 8 AS block_end_h, block_index * 8 + 8 AS prediction_time_h FROM blocks")(lambda s, d: B.block_index(_counts(s, d)))
register("blocked_features_long", f"SELECT hospital_id, stay_id_global, block_index, variable, obs_count, {r('mean', 'median', 'min', 'max', 'last')} FROM long")(lambda s, d: B.blocked_features_long(b.obs(s, d), _counts(s, d)))
register("blocked_features", "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in SELECTED if not c.endswith("obs_count")) + ") FROM features")(_features)
register("negative_time_qc", """SELECT hospital_id, stay_id_global, count(*) AS rows, min(time_us) AS min_us, max(time_us) AS max_us, array_to_string(list_slice(list_sort(list(DISTINCT time_us)), 1, 5), ',') AS examples FROM obs WHERE time_us < 0 GROUP BY ALL""")(
    lambda s, d: B.negative_time_qc(b.obs(s, d)).withColumn("examples", F.array_join(F.col("examples").cast("array<string>"), ","))
)
register("block_validation", """SELECT hospital_id, stay_id_global, block_count, coalesce(g, 0) AS generated, max_end_h, block_count * 8 AS terminal_block_end_h, true AS ok FROM counts
    LEFT JOIN (SELECT stay_id_global, count(*) AS g, max(block_index) * 8 + 8 AS max_end_h FROM blocks GROUP BY 1) USING (stay_id_global)""")(_validation)  # fmt: skip
register("block_count_distribution", "SELECT hospital_id, block_count, count(*) AS stays, round(count(*) / sum(count(*)) OVER (PARTITION BY hospital_id), 6) AS share FROM counts GROUP BY hospital_id, block_count")(lambda s, d: B.block_count_distribution(_counts(s, d)))
register("block_qc_summary", """WITH ends AS (SELECT c.*, icu_end_us > 0 AND icu_end_us % 28800000000 = 0 AS boundary, (SELECT max(block_index) * 8 + 8 FROM blocks k WHERE k.stay_id_global = c.stay_id_global) AS max_end_h FROM counts c),
    known AS (SELECT o.* FROM obs o WHERE (hospital_id, stay_id_global) IN (SELECT (hospital_id, stay_id_global) FROM counts))
    SELECT unnest(['block_size_hours', 'stays_total', 'stays_with_zero_blocks', 'stays_with_one_or_more_blocks', 'stays_ending_exactly_on_8h_boundary', 'block_index_is_generic_pre_analytic_structure', 'block_rows_total',
        'all_constructed_blocks_end_on_or_before_icu_end_time_proxy', 'exact_boundary_stays_have_terminal_block_end_equal_proxy']) AS metric,
    unnest([CAST(8 AS DOUBLE), count(*), count(*) FILTER (block_count = 0), count(*) FILTER (block_count > 0), count(*) FILTER (boundary), 1, (SELECT count(*) FROM blocks), min(CASE WHEN max_end_h * 3600000000 > icu_end_us THEN 0 ELSE 1 END),
        min(CASE WHEN boundary AND block_count * 28800000000 <> icu_end_us THEN 0 ELSE 1 END)]) AS value FROM ends
    UNION ALL SELECT unnest(['dynamic_rows_total', 'negative_dynamic_time_rows_in_input', 'negative_dynamic_time_stays_in_input']), unnest([CAST(count(*) AS DOUBLE), count(*) FILTER (time_us < 0), count(DISTINCT stay_id_global) FILTER (time_us < 0)]) FROM known""")(_block_qc)  # fmt: skip
EXAMPLES = """WITH RECURSIVE ranked AS (SELECT k, name, hospital_id, stay_id_global, icu_end_us, block_count, row_number() OVER (PARTITION BY k ORDER BY CASE k WHEN 4 THEN -block_count ELSE block_count END,
        CASE k WHEN 4 THEN -coalesce(icu_end_us, -1) ELSE 0 END, hospital_id, stay_id_global) AS r FROM counts,
        (VALUES (0, 'zero_blocks'), (1, 'exact_8h_boundary'), (2, 'single_block'), (3, 'multiple_blocks'), (4, 'max_block_count'), (5, 'additional_example')) n(k, name)
        WHERE CASE k WHEN 0 THEN block_count = 0 WHEN 1 THEN coalesce(icu_end_us > 0 AND icu_end_us % 28800000000 = 0, false) WHEN 2 THEN block_count = 1 WHEN 3 THEN block_count >= 2 ELSE true END),
    steps AS (SELECT least(i, 5) AS k, i FROM range(0, 10) x(i)),
    taken(i, ids, names) AS (SELECT CAST(-1 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]) UNION ALL
        SELECT t.i + 1, CASE WHEN len(t.ids) < 5 AND p.id IS NOT NULL THEN list_append(t.ids, p.id) ELSE t.ids END, CASE WHEN len(t.ids) < 5 AND p.id IS NOT NULL THEN list_append(t.names, p.name) ELSE t.names END
        FROM taken t JOIN steps s ON s.i = t.i + 1 LEFT JOIN LATERAL (SELECT first(stay_id_global ORDER BY r) AS id, first(name ORDER BY r) AS name FROM ranked WHERE ranked.k = s.k AND NOT list_contains(t.ids, stay_id_global)) p ON true),
    chosen AS (SELECT unnest(ids) AS id, unnest(names) AS example_type FROM taken WHERE i = 9)
    SELECT example_type, hospital_id, stay_id_global, round(icu_end_us / 3600000000.0, 6) AS icu_end_time_proxy_hours, block_count,
        coalesce((SELECT string_agg('[' || block_index * 8 || ', ' || block_index * 8 + 8 || ')', ', ' ORDER BY block_index) FROM blocks k WHERE k.stay_id_global = c.stay_id_global), '') AS block_boundaries
    FROM chosen JOIN counts c ON c.stay_id_global = id"""  # fmt: skip
register("example_stays", EXAMPLES)(lambda s, d: B.example_stays(_counts(s, d)))

# ventilation support

register("vent_episodes", f"SELECT hospital_id, stay_id_global, episode, start_us, end_us, timestamps, {r('duration_h')} FROM episodes")(_episodes)
register("vent_stay_level", f"SELECT hospital_id, stay_id_global, timestamps, episodes, {r('max_duration_h')}, passes FROM vqc")(_vent)
register("vent_hospital_summary", """SELECT hospital_id, count(*) AS stays, count(*) FILTER (passes) AS passing, round(count(*) FILTER (passes) / count(*), 6) AS share, round(min(max_duration_h), 6) AS min_h, round(quantile_cont(max_duration_h, 0.25), 6) AS p25_h,
    round(median(max_duration_h), 6) AS median_h, round(quantile_cont(max_duration_h, 0.75), 6) AS p75_h, round(max(max_duration_h), 6) AS max_h FROM vqc GROUP BY 1""")(lambda s, d: V.hospital_summary(_vent(s, d)))  # fmt: skip
register("vent_failed_stays", f"SELECT hospital_id, stay_id_global, {r('max_duration_h')}, CASE WHEN timestamps = 0 THEN 'no support' ELSE 'longest episode under 24 h' END AS reason FROM vqc WHERE NOT passes")(lambda s, d: V.failed_stays(_vent(s, d)))

# values

DIST = r("min", "q1", "median", "q3", "max", "iqr", "range")
register("distribution_summary", f"SELECT hospital_id, variable, n, {DIST} FROM dist")(lambda s, d: Q.distribution_summary(b.obs(s, d)))
register("distribution_summary_lineitem", f"""SELECT hospital_id, variable, n, {DIST} FROM (SELECT *, q3 - q1 AS iqr, max - min AS range FROM (SELECT 'site_' || (l_suppkey % 8) AS hospital_id, variable, count(*) AS n, min(value) AS min, quantile_cont(value, 0.25) AS q1,
    quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, max(value) AS max FROM (SELECT l_suppkey, unnest(['quantity', 'extendedprice', 'discount', 'tax']) AS variable, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value FROM lineitem)
    WHERE value IS NOT NULL GROUP BY ALL HAVING count(*) >= 20))""")(lambda s, d: Q.distribution_summary(_long_lineitem(s, d)))  # fmt: skip
register("distribution_issues", "SELECT * FROM issues")(lambda s, d: Q.distribution_issues(Q.distribution_summary(b.obs(s, d))))
register("numeric_summary", """SELECT variable, count(value) AS n, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(median(value), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max,
    round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr, array_to_string(list_transform(list_slice(list_sort(list(DISTINCT value)), 1, 10), lambda x: printf('%.4f', x)), ',') AS examples FROM obs WHERE value IS NOT NULL GROUP BY 1""")(lambda s, d: Q.numeric_summary(b.obs(s, d)))  # fmt: skip
register("invalid_value_cleaned", "SELECT o.hospital_id, o.stay_id_local, o.stay_id_global, o.time_us, o.row_ord, o.variable, CASE WHEN NOT coalesce(bad, false) THEN round(o.value, 6) END AS value FROM obs o LEFT JOIN judged USING (row_ord)")(lambda s, d: Q.clean_invalid(b.obs(s, d), _rules(s)))
register("invalid_value_qc", """SELECT hospital_id, variable, non_null_before, non_null_before - invalid_count AS non_null_after, invalid_count, round(CASE WHEN non_null_before > 0 THEN invalid_count / non_null_before ELSE 0 END, 6) AS invalid_proportion,
    coalesce(examples, '') AS invalid_examples, total AS variable_total_invalid_count, round(CASE WHEN total > 0 THEN invalid_count / total ELSE 0 END, 6) AS site_share, CASE WHEN total > 0 THEN first END AS dominant_site,
    round(CASE WHEN total > 0 THEN most / total ELSE 0 END, 6) AS dominant_share, total >= 5 AND most / total >= 0.5 AS concentrated FROM (SELECT *, CAST(sum(invalid_count) OVER (PARTITION BY variable) AS BIGINT) AS total, max(invalid_count) OVER (PARTITION BY variable) AS most,
    first_value(hospital_id) OVER (PARTITION BY variable ORDER BY invalid_count DESC, hospital_id) AS first FROM (SELECT s.hospital_id, r.variable, count(value) AS non_null_before, count(*) FILTER (bad) AS invalid_count,
    array_to_string(list_transform(list_slice(list_sort(list(DISTINCT value) FILTER (bad)), 1, 10), lambda x: printf('%.4f', x)), ',') AS examples FROM sites s CROSS JOIN rules r LEFT JOIN judged j ON j.hospital_id = s.hospital_id AND j.variable = r.variable GROUP BY ALL))""")(
    lambda s, d: Q.invalid_value_qc(b.obs(s, d), _rules(s), b.static(s, d))
)
register("semantic_actions_applied", f"SELECT hospital_id, stay_id_local, stay_id_global, time_us, row_ord, variable, {r('value')} FROM acted")(lambda s, d: Q.apply_actions(b.obs(s, d), _actions(s)))
register("semantic_decisions", """SELECT hospital_id, variable, CASE WHEN before = 0 THEN 'no action needed' WHEN action = 'divide' THEN 'unit conversion' WHEN action = 'set_missing' THEN 'site-specific invalid variable' WHEN variable = 'click' THEN 'unresolved mismatch' ELSE 'no action needed' END AS classification,
    CASE WHEN before = 0 THEN 'leave_missing' WHEN action IS NOT NULL THEN action WHEN variable = 'click' THEN 'keep_pending_review' ELSE 'keep' END AS applied_action, before > 0 AND action IS NULL AND variable = 'click' AS review_required,
    CASE WHEN before = 0 THEN 'retain' WHEN action = 'set_missing' THEN 'site_drop' WHEN action IS NULL AND variable = 'click' THEN 'exclude' ELSE 'retain' END AS recommendation, before AS non_null_before, after AS non_null_after,
    round(median_before, 6) AS median_before, round(median_after, 6) AS median_after, round(recip, 6) AS reciprocal_median_before, coalesce(flagged_metrics, '') AS flagged_metrics_before,
    CASE WHEN before = 0 THEN 'no values' WHEN action IS NOT NULL THEN 'median ' || m WHEN variable = 'click' THEN 'median ' || m || ', reciprocal ' || coalesce(printf('%.3f', recip), 'NA') WHEN flagged_metrics IS NOT NULL THEN 'flagged: ' || flagged_metrics ELSE 'none' END AS evidence
    FROM (SELECT s.hospital_id, t.variable, (SELECT count(value) FROM obs o WHERE o.hospital_id = s.hospital_id AND o.variable = t.variable) AS before, (SELECT count(value) FROM acted o WHERE o.hospital_id = s.hospital_id AND o.variable = t.variable) AS after,
    (SELECT median(value) FROM acted o WHERE o.hospital_id = s.hospital_id AND o.variable = t.variable) AS median_after, d.median AS median_before, CASE WHEN t.variable = 'click' AND d.median <> 0 THEN 1.0 / d.median END AS recip, coalesce(printf('%.3f', d.median), 'NA') AS m, i.flagged_metrics,
    CASE WHEN s.hospital_id = 'site_4' AND t.variable = 'view' THEN 'divide' WHEN s.hospital_id = 'site_6' AND t.variable = 'error' THEN 'set_missing' END AS action
    FROM sites s CROSS JOIN (VALUES ('click'), ('error'), ('view')) t(variable) LEFT JOIN dist d ON d.hospital_id = s.hospital_id AND d.variable = t.variable LEFT JOIN issues i ON i.hospital_id = s.hospital_id AND i.variable = t.variable)""")(
    lambda s, d: Q.semantic_decisions(b.obs(s, d), b.static(s, d), _actions(s), b.TARGETS, b.REVIEW)
)
register("missingness_matrix", "SELECT s.hospital_id, v.variable, NOT EXISTS (SELECT 1 FROM cobs c WHERE c.hospital_id = s.hospital_id AND c.variable = v.variable AND value IS NOT NULL) AS all_missing FROM sites s, (SELECT DISTINCT variable FROM obs) v")(
    lambda s, d: Q.missingness_matrix(b.cohort_obs(s, d), b.static(s, d), b.VARIABLES)
)
register("schema_summary", """SELECT s.hospital_id, coalesce((SELECT count(*) FROM cobs c WHERE c.hospital_id = s.hospital_id), 0) AS rows, CAST(5 AS BIGINT) AS columns,
    coalesce((SELECT string_agg(v.variable, ',' ORDER BY v.variable) FROM (SELECT DISTINCT variable FROM obs) v WHERE v.variable NOT IN (SELECT variable FROM cobs c WHERE c.hospital_id = s.hospital_id AND value IS NOT NULL)), '') AS all_missing FROM sites s""")(
    lambda s, d: Q.schema_summary(b.cohort_obs(s, d), b.static(s, d), b.VARIABLES)
)
register("describe_by_hospital", """SELECT hospital_id, variable, count(value) AS n, round(round(avg(value), 9), 6) AS mean, round(round(stddev_samp(value), 9), 6) AS std, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
    round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max FROM obs GROUP BY ALL""")(lambda s, d: _settled(Q.describe_by_hospital(b.obs(s, d)), "mean", "std"))  # fmt: skip
register("time_coverage", "SELECT hospital_id, count(*) AS rows, count(DISTINCT stay_id_global) AS stays, min(time_us) AS min_us, max(time_us) AS max_us FROM obs GROUP BY 1")(lambda s, d: Q.time_coverage(b.obs(s, d)))
CATEGORIES = ["sex", "bmi_group", "hosp_mortality", "icu_mortality"]
register("categorical_values", """SELECT hospital_id, variable, code, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY hospital_id, variable), 6) AS share FROM
    (SELECT hospital_id, unnest(['sex', 'bmi_group', 'hosp_mortality', 'icu_mortality']) AS variable, unnest([CASE k % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'M' WHEN 3 THEN 'X' END, CASE k % 9 WHEN 0 THEN 'Underweight' WHEN 1 THEN 'Normal Weight' WHEN 2 THEN 'Overweight'
    WHEN 3 THEN 'Obesity Class 1' WHEN 4 THEN 'Obesity Class 2' WHEN 5 THEN 'Obesity Class 3' WHEN 7 THEN 'Z' END, CASE k % 6 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '1' WHEN 4 THEN '0' END, CASE k % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '0' END]) AS code FROM rawstatic)
    GROUP BY hospital_id, variable, code""")(lambda s, d: B.value_counts(_static_harmonized(s, d), CATEGORIES))  # fmt: skip
MARKETS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
register("categorical_pivot", "SELECT hospital_id, " + ", ".join(f"count(*) FILTER (age_group = '{m}') AS age_group_{m}" for m in MARKETS) + " FROM static GROUP BY 1")(lambda s, d: Q.crosstab(b.static(s, d), "hospital_id", "age_group", MARKETS))
register("variable_crosstab", "SELECT CAST(icu_mortality AS VARCHAR) AS icu_mortality, count(*) FILTER (icu_readmit = 0) AS icu_readmit_0, count(*) FILTER (icu_readmit = 1) AS icu_readmit_1 FROM static GROUP BY 1")(
    lambda s, d: Q.crosstab(b.static(s, d).withColumn("icu_mortality", F.col("icu_mortality").cast("string")).withColumn("icu_readmit", F.col("icu_readmit").cast("string")), "icu_mortality", "icu_readmit", ["0", "1"])
)


def _support(s, d):
    """Two variables of one source row, in long form: events, where clicks and views stand for a support that is on or off, and values for its setting."""
    row = b.table(s, d, "events").select(b.site("user_id").alias("hospital_id"), F.col("event_id").alias("row_ord"), F.when(F.col("event_type") == "click", 1.0).when(F.col("event_type") == "view", 0.0).alias("on"), F.when(F.col("value") > 10, (F.floor("value") % 11).cast("double")).alias("setting"))
    long = row.select("hospital_id", "row_ord", F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("value")) for v in ("on", "setting")])).alias("x")).select("hospital_id", "row_ord", "x.*")
    return long.where("NOT (hospital_id = 'site_3' AND variable = 'on') AND NOT (hospital_id = 'site_5' AND variable = 'setting')")


SUPPORT = """WITH s AS (SELECT 'site_' || (user_id % 8) AS hospital_id, user_id % 8 AS k, CASE WHEN user_id % 8 = 3 THEN NULL WHEN event_type = 'click' THEN 1.0 WHEN event_type = 'view' THEN 0.0 END AS a,
    CASE WHEN value > 10 AND user_id % 8 <> 5 THEN CAST(floor(value) % 11 AS DOUBLE) END AS b FROM events)"""
register("variable_overlap", SUPPORT + """, h AS (SELECT hospital_id, any_value(k) <> 3 AS has_a, any_value(k) <> 5 AS has_b, count(a) AS a_non_null, count(b) AS b_non_null, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS both_non_null, count(*) FILTER (a = 1 AND b IS NOT NULL) AS a1_b_non_null,
    count(*) FILTER (a = 0 AND b IS NOT NULL) AS a0_b_non_null, array_to_string(list_transform(list_slice(list_sort(coalesce(list(DISTINCT a) FILTER (a IS NOT NULL), [])), 1, 10), lambda x: printf('%.2f', x)), ',') AS a_values,
    array_to_string(list_transform(list_slice(list_sort(coalesce(list(DISTINCT b) FILTER (b IS NOT NULL), [])), 1, 10), lambda x: printf('%.2f', x)), ',') AS b_values FROM s GROUP BY 1)
    SELECT sites.hospital_id, coalesce(has_a, false) AS has_a, coalesce(has_b, false) AS has_b, coalesce(a_non_null, 0) AS a_non_null, coalesce(b_non_null, 0) AS b_non_null, coalesce(both_non_null, 0) AS both_non_null, coalesce(a1_b_non_null, 0) AS a1_b_non_null,
    coalesce(a0_b_non_null, 0) AS a0_b_non_null, coalesce(a_values, '') AS a_values, coalesce(b_values, '') AS b_values FROM sites LEFT JOIN h USING (hospital_id)""")(
    lambda s, d: Q.overlap_summary(Q.paired(_support(s, d), "on", "setting"), b.static(s, d)).withColumns({c: F.array_join(F.transform(c, lambda x: F.format_string("%.2f", x)), ",") for c in ("a_values", "b_values")})
)
register("overlap_crosstab", SUPPORT + " SELECT hospital_id, a, " + ", ".join(f"count(*) FILTER (b = {i}) AS b_{i}_00" for i in range(11)) + " FROM s WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL")(lambda s, d: Q.overlap_crosstab(Q.paired(_support(s, d), "on", "setting")))
register("median_missingness", "SELECT hospital_id, " + ", ".join(f"round(avg(CASE WHEN {v}_median IS NULL THEN 1.0 ELSE 0.0 END), 6) AS {v}_median" for v in b.VARIABLES) + " FROM features GROUP BY 1")(
    lambda s, d: _features(s, d).groupBy("hospital_id").agg(*[F.avg(F.col(f"{v}_median").isNull().cast("double")).alias(f"{v}_median") for v in b.VARIABLES])
)
register("artifact_counts", "SELECT 'static' AS artifact, count(*) AS rows FROM static UNION ALL SELECT 'dynamic', count(*) FROM obs UNION ALL SELECT 'blocks', count(*) FROM blocks UNION ALL SELECT 'features', count(*) FROM long")(
    lambda s, d: Q.artifact_counts({"static": b.static(s, d), "dynamic": b.obs(s, d), "blocks": B.block_index(_counts(s, d)), "features": B.blocked_features_long(b.obs(s, d), _counts(s, d))})
)
register("column_profile", """SELECT "column", type, count(v) AS non_null, count(DISTINCT v) AS distinct_values, array_to_string(list_slice(list_sort(list(DISTINCT v) FILTER (v IS NOT NULL)), 1, 8), '|') AS examples FROM
    (SELECT unnest(['hospital_id', 'stay_id_global', 'stay_id_local', 'age_group', 'icu_mortality', 'icu_readmit', 'raw_outcome']) AS "column", unnest(['string', 'string', 'string', 'string', 'bigint', 'bigint', 'string']) AS type,
    unnest([hospital_id, stay_id_global, stay_id_local, age_group, CAST(icu_mortality AS VARCHAR), CAST(icu_readmit AS VARCHAR), raw_outcome]) AS v FROM static) GROUP BY ALL""")(lambda s, d: Q.column_profile(b.static(s, d)))  # fmt: skip


def _columns(s, d):
    """The variables that each hospital delivers, taken for the columns of its export."""
    return b.cohort_obs(s, d).where("value IS NOT NULL").select("hospital_id", F.col("variable").alias("column")).distinct()


register("schema_comparison", """SELECT s.hospital_id, list_sort(list(DISTINCT variable)) = (SELECT list_sort(list(DISTINCT variable)) FROM delivered WHERE hospital_id = 'site_0') AS same,
    coalesce((SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM (SELECT variable AS v FROM delivered WHERE hospital_id = 'site_0' EXCEPT SELECT variable FROM delivered WHERE hospital_id = s.hospital_id)), '') AS missing,
    coalesce((SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM (SELECT variable AS v FROM delivered WHERE hospital_id = s.hospital_id EXCEPT SELECT variable FROM delivered WHERE hospital_id = 'site_0')), '') AS extra,
    coalesce((SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM (SELECT variable AS v FROM delivered WHERE hospital_id = s.hospital_id INTERSECT SELECT variable FROM delivered WHERE hospital_id = 'site_0')), '') AS common FROM delivered s GROUP BY 1""")(
    lambda s, d: Q.schema_comparison(_columns(s, d), "site_0")
)
KNOWN = ["click", "view", "error", "refund"]
register("translation_coverage", """SELECT DISTINCT hospital_id, variable AS "column", 'unmapped' AS state FROM delivered WHERE variable NOT IN ('click', 'view', 'error', 'refund') UNION ALL
    SELECT h.hospital_id, k.c, 'unused' FROM (SELECT DISTINCT hospital_id FROM delivered) h, (VALUES ('click'), ('view'), ('error'), ('refund')) k(c) WHERE NOT EXISTS (SELECT 1 FROM delivered o WHERE o.hospital_id = h.hospital_id AND o.variable = k.c)""")(
    lambda s, d: Q.translation_coverage(_columns(s, d), s.createDataFrame([(k,) for k in KNOWN], "column string"))
)
MAPPING = {"interaction": ["view", "click"], "fault": ["error"], "commerce": ["purchase", "signup"]}
register("source_map", """SELECT h.hospital_id, m.name AS canonical_name, coalesce(string_agg(m.c, ',' ORDER BY m.i) FILTER (EXISTS (SELECT 1 FROM delivered o WHERE o.hospital_id = h.hospital_id AND o.variable = m.c)), '') AS raw_columns
    FROM (SELECT DISTINCT hospital_id FROM delivered) h, (VALUES ('interaction', 'view', 0), ('interaction', 'click', 1), ('fault', 'error', 0), ('commerce', 'purchase', 0), ('commerce', 'signup', 1)) m(name, c, i) GROUP BY ALL""")(
    lambda s, d: H.source_map(_columns(s, d), MAPPING)
)
THEMES = {"web": ["interaction"], "trouble": ["fault"]}
register("source_map_themes", """SELECT DISTINCT CASE m.name WHEN 'interaction' THEN 'web' WHEN 'fault' THEN 'trouble' END AS theme, m.name AS canonical_name, coalesce((SELECT string_agg(n.c, ',' ORDER BY n.i) FROM
    (VALUES ('interaction', 'view', 0), ('interaction', 'click', 1), ('fault', 'error', 0), ('commerce', 'purchase', 0), ('commerce', 'signup', 1)) n(name, c, i) WHERE n.name = m.name AND EXISTS (SELECT 1 FROM delivered o WHERE o.hospital_id = h.hospital_id AND o.variable = n.c)), '') AS raw_columns
    FROM (SELECT DISTINCT hospital_id FROM delivered) h, (VALUES ('interaction'), ('fault'), ('commerce')) m(name)""")(lambda s, d: H.with_themes(H.source_map(_columns(s, d), MAPPING), THEMES))  # fmt: skip

# raw exports


register("static_harmonized", """SELECT hospital_id, hospital_id || '_' || k AS stay_id_global, CAST(k AS VARCHAR) AS stay_id_local, c_mktsegment AS age_group, CASE k % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'M' WHEN 3 THEN 'X' END AS sex, CAST(NULL AS VARCHAR) AS height_group,
    CAST(NULL AS VARCHAR) AS weight_group, CASE k % 9 WHEN 0 THEN 'Underweight' WHEN 1 THEN 'Normal Weight' WHEN 2 THEN 'Overweight' WHEN 3 THEN 'Obesity Class 1' WHEN 4 THEN 'Obesity Class 2' WHEN 5 THEN 'Obesity Class 3' WHEN 7 THEN 'Z' END AS bmi_group,
    CAST(CASE k % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 4 THEN 0 END AS BIGINT) AS hosp_mortality, CAST(CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 0 END AS BIGINT) AS icu_mortality, CAST(NULL AS BIGINT) AS hosp_los,
    CAST(CASE WHEN k % 7 = 0 OR k % 10 = 0 THEN NULL ELSE k % 40 END AS BIGINT) AS icu_los, CAST(CASE WHEN k % 11 = 0 THEN NULL WHEN k % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS icu_readmit, CAST(NULL AS BIGINT) AS dialysis_free_days, CAST(NULL AS BIGINT) AS vent_free_days, CAST(NULL AS VARCHAR) AS icd10_codes FROM rawstatic""")(
    _static_harmonized
)
register("static_with_blocks", "SELECT s.hospital_id, s.stay_id_global, s.age_group, s.icu_mortality, c.icu_end_us, c.block_count, round(c.icu_end_us / 3600000000.0, 6) AS icu_end_time_proxy_hours FROM static s LEFT JOIN counts c USING (stay_id_global)")(
    lambda s, d: C.with_block_counts(b.static(s, d).select("hospital_id", "stay_id_global", "age_group", "icu_mortality"), _counts(s, d))
)
register("unexpected_categories", """SELECT hospital_id, c AS "column", v AS value, count(*) AS n FROM (SELECT hospital_id, 'sex' AS c, 'X' AS v FROM rawstatic WHERE k % 5 = 3 UNION ALL SELECT hospital_id, 'bmi_group', 'Z' FROM rawstatic WHERE k % 9 = 7
    UNION ALL SELECT hospital_id, 'hosp_mortality', 'unknown' FROM rawstatic WHERE k % 6 = 3 UNION ALL SELECT hospital_id, 'icu_mortality', 'weird' FROM rawstatic WHERE k % 5 = 3) GROUP BY ALL""")(lambda s, d: H.unexpected_categories(b.raw_static(s, d), F.col("hospital_id")))  # fmt: skip
register("alias_agreement", "SELECT hospital_id, count(*) FILTER (k % 97 = 0) AS different_rows, count(*) FILTER (k % 97 = 0) = 0 AS agree FROM rawstatic GROUP BY 1")(lambda s, d: H.alias_agreement(b.raw_static(s, d), F.col("hospital_id"), "PseudoID", "Pseudo-ID"))
register("stay_ids", "SELECT k AS c_custkey, CAST(k AS VARCHAR) AS stay_id_local, hospital_id || '_' || k AS stay_id_global FROM rawstatic")(
    lambda s, d: b.raw_static(s, d).select(X.local_stay_id("PseudoID").cast("bigint").alias("c_custkey"), X.local_stay_id("PseudoID").alias("stay_id_local"), X.global_stay_id("hospital_id", X.local_stay_id("PseudoID")).alias("stay_id_global"))
)


def _parsed(s, d):
    raw = b.raw_values(s, d)
    name = F.when(F.col("column") == "ie_ratio", F.col("column")).otherwise(F.concat(F.lit("event_"), "column")).alias("canonical_name")
    return raw.select("event_id", "hospital_id", "column", name, X.clean("text").alias("text"), X.number("text").alias("plain"), H.numeric_value(F.col("text"), F.col("column"), F.col("hospital_id"), b.LAB_SITE).alias("parsed"))


register("dynamic_harmonized", f"SELECT event_id, hospital_id, col AS variable, {r('value')} FROM parsed")(lambda s, d: _parsed(s, d).select("event_id", "hospital_id", F.col("column").alias("variable"), F.col("parsed").alias("value")))
NAMES = {"click": "ie_ratio", "view": "heart_rate", "purchase": "peep", "error": "crp", "signup": "spo2"}
register("dynamic_harmonized_table", "SELECT p.hospital_id, CAST(user_id AS VARCHAR) AS stay_id_local, p.hospital_id || '_' || user_id AS stay_id_global, (p.event_id % 4000) * 60000000 AS time_us, p.event_id AS row_ord, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items()) + " END AS variable, round(p.value, 6) AS value FROM parsed p JOIN events e USING (event_id) WHERE p.value IS NOT NULL")(
    lambda s, d: H.harmonize_dynamic_long(b.raw_dynamic(s, d), F.col("hospital_id"), laboratory_site=b.LAB_SITE)
)
register("non_numeric_issues", """SELECT hospital_id, col AS "column", CASE WHEN col = 'ie_ratio' THEN col ELSE 'event_' || col END AS canonical_name, count(*) FILTER (form <> 5) AS non_null, count(*) FILTER (form <> 5 AND plain IS NULL) AS non_numeric, count(*) FILTER (plain IS NULL AND value IS NOT NULL) AS resolved,
    count(*) FILTER (form <> 5 AND value IS NULL) AS unresolved, coalesce(array_to_string(list_slice(list_sort(list(DISTINCT text) FILTER (form <> 5 AND value IS NULL)), 1, 10), '|'), '') AS examples FROM parsed GROUP BY ALL HAVING count(*) FILTER (form <> 5 AND plain IS NULL) > 0""")(
    lambda s, d: Q.non_numeric_issues(_parsed(s, d))
)


def _time_texts(s, d):
    """Seconds since the first of January, written in four ways or not at all."""
    e = b.table(s, d, "events").select("event_id", ((F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(1704067200000000)) / 1_000_000).cast("bigint").alias("s"))
    clock = "lpad(cast(s DIV 3600 % 24 AS string), 2, '0'), ':', lpad(cast(s DIV 60 % 60 AS string), 2, '0'), ':', lpad(cast(s % 60 AS string), 2, '0')"
    return e.selectExpr("event_id", f"CASE event_id % 5 WHEN 0 THEN concat('-', s DIV 3600, 'h') WHEN 1 THEN concat(s DIV 86400, ' days ', {clock}) WHEN 2 THEN concat({clock}) WHEN 3 THEN concat(s DIV 60, ' min') ELSE 'soon' END AS text")


register("time_parse", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN -(s // 3600) * 3600000000 WHEN 1 THEN s * 1000000 WHEN 2 THEN s % 86400 * 1000000 WHEN 3 THEN s // 60 * 60000000 END AS time_us
    FROM (SELECT event_id, (epoch_us(ts) - 1704067200000000) // 1000000 AS s FROM events)""")(lambda s, d: _time_texts(s, d).select("event_id", X.time_us("text").alias("time_us")))  # fmt: skip

# identity

register("unique_stays_per_hospital", """SELECT hospital_id, count(DISTINCT stay_id_global) AS stays, count(DISTINCT stay_id_global) FILTER (of_static) AS static_stays
    FROM (SELECT hospital_id, stay_id_global, true AS of_static FROM dstatic UNION ALL SELECT hospital_id, stay_id_global, false FROM dobs) GROUP BY 1""")(lambda s, d: I.unique_stays_per_hospital(b.dirty_static(s, d), b.dirty_obs(s, d)))  # fmt: skip
register("local_id_collisions", """SELECT DISTINCT d.stay_id_local, hospital_id, stay_id_global, hospitals FROM dstatic d
    JOIN (SELECT stay_id_local, count(DISTINCT hospital_id) AS hospitals FROM dstatic GROUP BY 1 HAVING count(DISTINCT hospital_id) > 1) m ON m.stay_id_local IS NOT DISTINCT FROM d.stay_id_local""")(lambda s, d: I.local_id_collisions(b.dirty_static(s, d)))  # fmt: skip
register("missing_id_rows", "SELECT 'static' AS source, hospital_id, stay_id_local, stay_id_global, CAST(NULL AS BIGINT) AS time_us FROM dstatic WHERE stay_id_local IS NULL UNION ALL SELECT 'dynamic', hospital_id, stay_id_local, stay_id_global, time_us FROM dobs WHERE stay_id_local IS NULL")(
    lambda s, d: I.missing_id_rows(b.dirty_static(s, d), b.dirty_obs(s, d))
)
register("static_duplicates", "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY stay_id_global) AS duplicate_count FROM dstatic) WHERE duplicate_count > 1")(lambda s, d: I.static_duplicates(b.dirty_static(s, d)))
FAILED = """(SELECT row_ord, o.hospital_id, o.stay_id_local, o.stay_id_global, o.time_us, CASE WHEN n IS NULL THEN 'missing_static_match' WHEN n <> 1 OR g <> 1 THEN 'ambiguous_static_mapping' WHEN first <> o.stay_id_global THEN 'mismatched_stay_id_global' END AS reason
    FROM dobs o LEFT JOIN (SELECT hospital_id AS h, stay_id_local AS l, count(*) AS n, count(DISTINCT stay_id_global) AS g, min(stay_id_global) AS first FROM dstatic GROUP BY ALL) ON h IS NOT DISTINCT FROM o.hospital_id AND l IS NOT DISTINCT FROM o.stay_id_local)"""
register("mapping_failures", f"SELECT * FROM {FAILED} WHERE reason IS NOT NULL")(lambda s, d: I.mapping_failures(b.dirty_static(s, d), b.dirty_obs(s, d)))
register("duplicate_time_rows", "SELECT row_ord, hospital_id, stay_id_global, time_us, duplicate_count FROM (SELECT *, count(*) OVER (PARTITION BY stay_id_global, time_us) AS duplicate_count FROM dobs) WHERE duplicate_count > 1")(lambda s, d: I.duplicate_time_rows(b.dirty_obs(s, d)))
register("stay_id_summary", f"""SELECT unnest(['static_rows_total', 'static_unique_stay_id_global_total', 'unique_stays_hospital_count', 'duplicated_stay_id_local_values_across_hospitals', 'failed_or_missing_static_dynamic_mappings',
    'rows_missing_hospital_id_or_stay_id_local', 'duplicate_static_stay_id_global_rows', 'duplicate_dynamic_rows_within_stay_time']) AS metric, CAST(unnest([count(*), count(DISTINCT stay_id_global), count(DISTINCT hospital_id),
    (SELECT count(*) FROM (SELECT stay_id_local FROM dstatic WHERE stay_id_local IS NOT NULL GROUP BY 1 HAVING count(DISTINCT hospital_id) > 1)), (SELECT count(*) FROM {FAILED} WHERE reason IS NOT NULL),
    (SELECT count(*) FROM dstatic WHERE stay_id_local IS NULL) + (SELECT count(*) FROM dobs WHERE stay_id_local IS NULL), (SELECT count(*) FROM (SELECT count(*) OVER (PARTITION BY stay_id_global) AS n FROM dstatic) WHERE n > 1),
    (SELECT count(*) FROM (SELECT count(*) OVER (PARTITION BY stay_id_global, time_us) AS n FROM dobs) WHERE n > 1)]) AS DOUBLE) AS value FROM dstatic""")(lambda s, d: I.stay_id_summary(b.dirty_static(s, d), b.dirty_obs(s, d)))  # fmt: skip

# cohort

register("dynamic_presence", "SELECT *, true AS has_dynamic_data FROM presence")(lambda s, d: C.dynamic_presence(b.cohort_obs(s, d)))
register("vital_group_coverage", "SELECT * FROM coverage")(lambda s, d: C.vital_group_coverage(b.static(s, d), b.cohort_obs(s, d), _groups(s)))
register("site_eligibility", "SELECT * FROM eligibility")(lambda s, d: _listed(_sites(s, d)))
OUTCOMES = {"icu_mortality": ["raw_outcome"]}
register("outcome_provenance", """SELECT hospital_id, count(icu_mortality) AS harmonized_non_null, CASE WHEN hospital_id = 'site_6' THEN NULL ELSE count(raw_outcome) END AS raw_non_null, CASE WHEN count(icu_mortality) > 0 THEN 'verified_non_missing_harmonized_icu_mortality'
    WHEN hospital_id = 'site_6' THEN 'raw_source_verification_not_available' WHEN hospital_id = 'site_3' THEN 'verified_no_raw_icu_mortality_source_column' WHEN count(raw_outcome) = 0 THEN 'verified_raw_icu_mortality_source_present_but_all_missing' ELSE 'raw_values_lost' END AS status
    FROM (SELECT * REPLACE (CASE WHEN hospital_id IN ('site_3', 'site_5', 'site_6', 'site_7') THEN NULL ELSE icu_mortality END AS icu_mortality, CASE WHEN hospital_id = 'site_5' THEN NULL ELSE raw_outcome END AS raw_outcome) FROM static) GROUP BY 1""")(_provenance)  # fmt: skip
register("site_counts", "SELECT unnest(['hospitals_before', 'hospitals_after', 'hospitals_excluded']) AS metric, unnest([CAST(count(*) AS DOUBLE), count(*) FILTER (site_included), count(*) FILTER (NOT site_included)]) AS value FROM eligibility")(lambda s, d: C.site_counts(_sites(s, d)))
register("stay_exclusions", f"SELECT * REPLACE ({r('icu_end_time_proxy_hours')}) FROM exclusions")(lambda s, d: _listed(_exclusions(s, d)))
register("attrition_by_hospital", "SELECT hospital_id, count(*) AS before, count(*) FILTER (after_site) AS after_site, count(*) FILTER (after_no_data) AS after_no_data, count(*) FILTER (after_missing_readmission) AS after_missing_readmission, count(*) FILTER (retained) AS retained FROM exclusions GROUP BY 1")(lambda s, d: C.attrition_by_hospital(_exclusions(s, d)))
register("exclusion_summary_by_hospital", "SELECT hospital_id, count(*) AS stays, count(*) FILTER (exclude_site) AS exclude_site, count(*) FILTER (exclude_no_data) AS exclude_no_data, count(*) FILTER (exclude_missing_readmission) AS exclude_missing_readmission, count(*) FILTER (exclude_readmission) AS exclude_readmission, count(*) FILTER (retained) AS retained FROM exclusions GROUP BY 1")(lambda s, d: C.exclusion_summary_by_hospital(_exclusions(s, d)))
register("retained_stays", f"SELECT hospital_id, stay_id_global, readmission, icu_mortality, {r('icu_end_time_proxy_hours')} FROM exclusions WHERE retained")(lambda s, d: C.retained_stays(_exclusions(s, d)))
register("retained_hospitals", "SELECT hospital_id, count(*) AS retained_stays FROM exclusions WHERE retained GROUP BY 1")(lambda s, d: C.retained_hospitals(_exclusions(s, d)))

# instances

register("candidate_instances", f"SELECT * REPLACE ({r('icu_end_time_proxy_hours')}) FROM candidates")(_candidates)
register("valid_instances", f"SELECT * EXCLUDE (valid_instance, exclusion_reason) REPLACE ({r('icu_end_time_proxy_hours')}) FROM candidates WHERE valid_instance")(lambda s, d: P.valid_instances(_candidates(s, d)))
register("instance_counts", "SELECT horizon_h, count(*) AS candidates, count(*) FILTER (valid_instance) AS valid, count(*) FILTER (NOT valid_instance) AS excluded FROM candidates GROUP BY 1")(lambda s, d: P.instance_counts(_candidates(s, d)))
register("instance_exclusions", "SELECT horizon_h, exclusion_reason, count(*) AS n FROM candidates WHERE NOT valid_instance GROUP BY ALL")(lambda s, d: P.instance_exclusions(_candidates(s, d)))
register("labels", f"SELECT * REPLACE ({r('icu_end_time_proxy_hours')}) FROM labels_")(_labels)
register("usable_labels", f"SELECT * EXCLUDE (label_available) REPLACE ({r('icu_end_time_proxy_hours')}) FROM labels_ WHERE label_available")(lambda s, d: P.usable_labels(_labels(s, d)))
register("label_summary", "SELECT horizon_h, count(*) AS valid, count(label_value) AS labelled, count(*) FILTER (label_value = 1) AS positive, count(*) FILTER (label_value = 0) AS negative, count(*) FILTER (label_value IS NULL) AS missing FROM labels_ GROUP BY 1")(lambda s, d: P.label_summary(_labels(s, d)))
register("model_ready", "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in SELECTED if not c.endswith("obs_count")) + ") FROM ready")(_ready)
register("readiness_summary", f"SELECT unnest(['rows', 'selected_features', 'horizons']) AS metric, unnest([CAST(count(*) AS DOUBLE), {len(SELECTED)}, count(DISTINCT horizon_h)]) AS value FROM ready")(lambda s, d: P.readiness_summary(_ready(s, d), SELECTED))
register("feature_availability", " UNION ALL ".join(f"SELECT horizon_h, '{c}' AS feature, count({c}) AS non_missing, count(*) AS rows, round(count({c}) / count(*), 6) AS share FROM ready GROUP BY 1" for c in SELECTED))(lambda s, d: P.feature_availability(_ready(s, d), SELECTED))
