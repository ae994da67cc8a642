"""Views that give the test tables the shape of clinical exports, in Spark and (BASE_SQL) in SQL.

events: one row is one observation of a stay (its user); customer: one row is a raw static record. The views keep every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.instances import LABEL_NAME, LABEL_SEMANTICS

VARIABLES = ["click", "error", "purchase", "signup", "view"]
MARKERS = ["purchase", "error", "signup"]
GROUPS = {"cardiac_rate": ["click"], "blood_pressure": ["view", "purchase"], "respiratory": ["signup"], "oxygenation": ["error"]}
RULES = [("click", 0.0, 150.0, False), ("error", 1.0, 120.0, False), ("purchase", None, 80.0, False), ("signup", 0.0, None, True), ("view", 2.0, 100.0, True)]
ACTIONS = [("site_4", "view", "divide", 7.50062), ("site_6", "error", "set_missing", None)]
TARGETS, REVIEW = ["click", "error", "view"], ["click"]
LAB_SITE = "site_4"
ORIGIN_US = 1704110400000000  # 2024-01-01 12:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site(key: str):
    return F.concat(F.lit("site_"), (F.col(key) % 8).cast("string"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = F.col("user_id").cast("string")
    time = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(ORIGIN_US)
    return table(spark, sf_dir, "events").select(site("user_id").alias("hospital_id"), local.alias("stay_id_local"), F.concat(site("user_id"), F.lit("_"), local).alias("stay_id_global"), time.alias("time_us"), F.col("event_id").alias("row_ord"), F.col("event_type").alias("variable"), "value")


def static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as stays; most have no events."""
    k = F.col("c_custkey")
    died = F.when(site("c_custkey").isin("site_3", "site_7"), F.lit(None)).when(F.col("c_acctbal") < 0, 1).when(k % 11 == 0, F.lit(None)).otherwise(0)
    again = F.when(k % 13 == 0, F.lit(None)).when(k % 7 == 0, 1).otherwise(0)
    raw = F.when(site("c_custkey") == "site_3", F.lit(None)).otherwise("given")
    return table(spark, sf_dir, "customer").select(site("c_custkey").alias("hospital_id"), F.concat(site("c_custkey"), F.lit("_"), k.cast("string")).alias("stay_id_global"), k.cast("string").alias("stay_id_local"), F.col("c_mktsegment").alias("age_group"), died.cast("long").alias("icu_mortality"), again.cast("long").alias("icu_readmit"), raw.alias("raw_outcome"))


def cohort_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of which one site has no values of two groups."""
    lacking = (F.col("hospital_id") == "site_5") & F.col("variable").isin("signup", "error")
    return obs(spark, sf_dir).withColumn("value", F.when(~lacking, F.col("value")))


def dirty_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays, some twice and some without a local id."""
    s = static(spark, sf_dir).select("hospital_id", "stay_id_local", "stay_id_global")
    s = s.unionByName(s.where("CAST(stay_id_local AS BIGINT) % 29 = 0"))
    return s.withColumn("stay_id_local", F.expr("CASE WHEN CAST(stay_id_local AS BIGINT) % 31 = 0 THEN NULL WHEN CAST(stay_id_local AS BIGINT) % 5 = 0 THEN '7' ELSE stay_id_local END"))


def dirty_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations, some without ids, of unknown stays, of other stays, or at a stay's first time."""
    o = obs(spark, sf_dir).select("row_ord", "hospital_id", "stay_id_local", "stay_id_global", "time_us")
    o = o.withColumn("stay_id_local", F.expr("CASE WHEN row_ord % 97 = 0 THEN NULL WHEN row_ord % 101 = 0 THEN 'none' ELSE stay_id_local END"))
    o = o.withColumn("stay_id_global", F.expr("CASE WHEN row_ord % 103 = 0 THEN concat(stay_id_global, 'x') ELSE stay_id_global END"))
    return o.withColumn("time_us", F.expr("CASE WHEN row_ord % 89 = 0 THEN 0 ELSE time_us END"))


def raw_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw static records with the defects of exports."""
    k = "c_custkey"
    return table(spark, sf_dir, "customer").selectExpr(
        f"concat('site_', {k} % 8) AS hospital_id",
        f"CASE {k} % 4 WHEN 0 THEN lpad(cast({k} AS string), 9, '0') WHEN 1 THEN concat({k}, '.0') WHEN 2 THEN concat(' ', {k}, ' ') ELSE cast({k} AS string) END AS PseudoID",
        f"CASE WHEN {k} % 97 = 0 THEN 'other' ELSE CASE {k} % 4 WHEN 0 THEN lpad(cast({k} AS string), 9, '0') WHEN 1 THEN concat({k}, '.0') ELSE cast({k} AS string) END END AS `Pseudo-ID`",
        f"CASE {k} % 5 WHEN 0 THEN 'w' WHEN 1 THEN 'M' WHEN 2 THEN ' m ' WHEN 3 THEN 'X' END AS clusterGeschlecht",
        f"CASE {k} % 9 WHEN 0 THEN 'L' WHEN 1 THEN 'm' WHEN 2 THEN 'P' WHEN 3 THEN '1' WHEN 4 THEN '2' WHEN 5 THEN '3' WHEN 6 THEN 'x' WHEN 7 THEN 'Z' ELSE '' END AS BMI",
        f"CASE {k} % 6 WHEN 0 THEN 'verlegt_intern' WHEN 1 THEN 'Verstorben' WHEN 2 THEN 'verstoben' WHEN 3 THEN 'unknown' WHEN 4 THEN 'verlegt, verstorben' END AS `Entlassgrund_(verlegt_intern,_verlegt_extern,_verstorben)`",
        f"CASE {k} % 5 WHEN 0 THEN 'ICU' WHEN 1 THEN '0' WHEN 2 THEN 'kh' WHEN 3 THEN 'weird' ELSE '' END AS Sterblichkeit",
        f"CASE WHEN {k} % 7 = 0 THEN '-1' WHEN {k} % 10 = 0 THEN '3.5' ELSE cast({k} % 40 AS string) END AS Liegedauer_ICU",
        f"CASE WHEN {k} % 11 = 0 THEN '-1.0' WHEN {k} % 3 = 0 THEN '1' ELSE '0' END AS Wiederaufnahme_ICU",
        "c_mktsegment AS clusterAlter",
    )


#: Raw columns that stand for the event types in `raw_dynamic`.
RAW_COLUMNS = {"click": "I:E", "view": "HF", "purchase": "PEEP", "error": "CRP", "signup": "SpO2"}


def raw_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw time-series rows: one row an event, with a column for each event type under an export's name."""
    texts = raw_values(spark, sf_dir).withColumnRenamed("event_id", "row_ord")
    event = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_ord"), "event_type", F.col("user_id").cast("string").alias("PseudoID"), F.concat((F.col("event_id") % 4000).cast("string"), F.lit(" min")).alias("Time"))
    rows = event.join(texts.select("row_ord", "hospital_id", "text"), "row_ord")
    return rows.select("row_ord", "hospital_id", "PseudoID", "Time", *[F.when(F.col("event_type") == kind, F.col("text")).alias(raw) for kind, raw in RAW_COLUMNS.items()])


def raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's value as an export might render it: column, text, and what it means (column: `ie_ratio` for clicks)."""
    return table(spark, sf_dir, "events").selectExpr("event_id", "concat('site_', user_id % 8) AS hospital_id", "if(event_type = 'click', 'ie_ratio', event_type) AS column", "event_id % 8 AS form", "cast(floor(value * 100) AS bigint) AS cents").selectExpr(
        "event_id", "hospital_id", "column",
        "CASE form WHEN 0 THEN concat('<', cents DIV 100) WHEN 1 THEN concat('> ', cents DIV 100, ',', lpad(cast(cents % 100 AS string), 2, '0')) WHEN 2 THEN concat(cents DIV 100, ',', lpad(cast(cents % 100 AS string), 2, '0')) WHEN 3 THEN 'kein  Material' WHEN 4 THEN '1:2,5' WHEN 5 THEN '  ' WHEN 6 THEN 'abc' ELSE concat(cents DIV 100, '.', lpad(cast(cents % 100 AS string), 2, '0')) END AS text",
    )


BASE_SQL = """
obs AS (SELECT 'site_' || (user_id % 8) AS hospital_id, CAST(user_id AS VARCHAR) AS stay_id_local, 'site_' || (user_id % 8) || '_' || user_id AS stay_id_global,
        epoch_us(ts) - 1704110400000000 AS time_us, event_id AS row_ord, event_type AS variable, value FROM events),
static AS (SELECT 'site_' || (c_custkey % 8) AS hospital_id, 'site_' || (c_custkey % 8) || '_' || c_custkey AS stay_id_global, CAST(c_custkey AS VARCHAR) AS stay_id_local, c_mktsegment AS age_group,
        CAST(CASE WHEN c_custkey % 8 IN (3, 7) THEN NULL WHEN c_acctbal < 0 THEN 1 WHEN c_custkey % 11 = 0 THEN NULL ELSE 0 END AS BIGINT) AS icu_mortality,
        CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS icu_readmit, CASE WHEN c_custkey % 8 = 3 THEN NULL ELSE 'given' END AS raw_outcome
        FROM customer),
proxy AS (SELECT stay_id_global, max(time_us) AS icu_end_us FROM obs GROUP BY 1),
stays AS (SELECT s.hospital_id, s.stay_id_global, icu_readmit AS readmission, icu_mortality, CAST(0 AS BIGINT) AS icu_admission_us, icu_end_us, icu_end_us / 3600000000.0 AS icu_end_time_proxy_hours
        FROM static s LEFT JOIN proxy USING (stay_id_global)),
counts AS (SELECT hospital_id, stay_id_global, icu_end_us, CASE WHEN icu_end_us >= 0 THEN icu_end_us // 28800000000 ELSE 0 END AS block_count FROM stays),
blocks AS (SELECT hospital_id, stay_id_global, unnest(range(0, block_count)) AS block_index FROM counts),
inblock AS (SELECT o.*, o.time_us // 28800000000 AS block_index FROM obs o JOIN counts c USING (hospital_id, stay_id_global) WHERE time_us >= 0 AND time_us // 28800000000 < block_count),
long AS (SELECT hospital_id, stay_id_global, block_index, variable, count(*) AS obs_count, avg(value) AS mean, median(value) AS median, min(value) AS min, max(value) AS max,
        arg_max(value, row(time_us, row_ord)) AS last FROM inblock WHERE value IS NOT NULL GROUP BY ALL),
cobs AS (SELECT * REPLACE (CASE WHEN NOT (hospital_id = 'site_5' AND variable IN ('signup', 'error')) THEN value END AS value) FROM obs),
delivered AS (SELECT DISTINCT hospital_id, variable FROM cobs WHERE value IS NOT NULL),
presence AS (SELECT hospital_id, stay_id_global, count(*) AS dynamic_row_count FROM cobs GROUP BY ALL),
sites AS (SELECT DISTINCT hospital_id FROM static),
groups(physiologic_group, variable, ord) AS (VALUES ('cardiac_rate', 'click', 0), ('blood_pressure', 'view', 0), ('blood_pressure', 'purchase', 1), ('respiratory', 'signup', 0), ('oxygenation', 'error', 0)),
covered AS (SELECT hospital_id, physiologic_group, variable, ord, (SELECT count(value) FROM cobs c WHERE c.hospital_id = s.hospital_id AND c.variable = g.variable) AS n FROM sites s, groups g),
coverage AS (SELECT hospital_id, physiologic_group, true AS required, string_agg(variable, ',' ORDER BY ord) AS candidates, coalesce(string_agg(variable, ',' ORDER BY ord) FILTER (n > 0), '') AS satisfied_by,
        count(*) FILTER (n > 0) > 0 AS group_usable, string_agg(variable || '=' || n, ',' ORDER BY ord) AS non_null_counts FROM covered GROUP BY ALL),
elig AS (SELECT hospital_id, count(*) AS site_stay_count, count(DISTINCT p.stay_id_global) AS stays_with_dynamic_data, count(icu_mortality) AS outcome_non_null,
        coalesce(string_agg(DISTINCT CAST(icu_mortality AS VARCHAR), ',' ORDER BY CAST(icu_mortality AS VARCHAR)), '') AS outcome_codes
        FROM stays s LEFT JOIN presence p USING (hospital_id, stay_id_global) GROUP BY 1),
usable AS (SELECT hospital_id, count(*) FILTER (group_usable) AS usable_groups, coalesce(string_agg(physiologic_group, ',' ORDER BY physiologic_group) FILTER (NOT group_usable), '') AS missing_groups, {satisfied} FROM coverage GROUP BY 1),
eligibility AS (SELECT *, outcome_non_null > 0 AS outcome_available, usable_groups >= 3 AS core_vitals_eligible, outcome_non_null > 0 AND usable_groups >= 3 AS site_included,
        to_json(list_filter([CASE WHEN outcome_non_null = 0 THEN 'missing/unusable icu_mortality' END, CASE WHEN usable_groups < 3 THEN 'insufficient core-vitals coverage' END], lambda x: x IS NOT NULL)) AS exclusion_reasons,
        concat_ws('; ', CASE WHEN outcome_non_null = 0 THEN 'missing/unusable icu_mortality' END, CASE WHEN usable_groups < 3 THEN 'insufficient core-vitals coverage' END) AS exclusion_reason FROM elig JOIN usable USING (hospital_id)),
flags AS (SELECT s.hospital_id, s.stay_id_global, readmission, icu_mortality, icu_end_time_proxy_hours, coalesce(dynamic_row_count, 0) AS dynamic_row_count, coalesce(dynamic_row_count, 0) > 0 AS has_dynamic_data,
        site_included AND coalesce(readmission = 0, false) AS first_stay_proxy_eligible, exclusion_reasons AS site_exclusion_reasons, exclusion_reason AS site_exclusion_reason, NOT site_included AS exclude_site,
        site_included AND coalesce(dynamic_row_count, 0) = 0 AS exclude_no_data, site_included AND readmission IS NULL AS exclude_missing_readmission, site_included AND coalesce(readmission = 1, false) AS exclude_readmission
        FROM stays s JOIN eligibility USING (hospital_id) LEFT JOIN presence p ON p.stay_id_global = s.stay_id_global),
exclusions AS (SELECT *, NOT exclude_site AS after_site, NOT exclude_site AND NOT exclude_no_data AS after_no_data, NOT exclude_site AND NOT exclude_no_data AND NOT exclude_missing_readmission AS after_missing_readmission,
        NOT exclude_site AND NOT exclude_no_data AND NOT exclude_missing_readmission AND NOT exclude_readmission AS retained,
        to_json(list_filter([CASE WHEN exclude_no_data THEN 'no dynamic data' END, CASE WHEN exclude_missing_readmission THEN 'missing readmission' END, CASE WHEN exclude_readmission THEN 'readmission flagged' END], lambda x: x IS NOT NULL)) AS stay_exclusion_reasons,
        concat_ws('; ', CASE WHEN exclude_no_data THEN 'no dynamic data' END, CASE WHEN exclude_missing_readmission THEN 'missing readmission' END, CASE WHEN exclude_readmission THEN 'readmission flagged' END) AS exclusion_reason,
        CASE WHEN exclude_site THEN 'excluded_site' WHEN exclude_no_data OR exclude_missing_readmission OR exclude_readmission THEN 'excluded_stay' ELSE 'retained' END AS status FROM flags),
features AS (SELECT b.hospital_id, b.stay_id_global, b.block_index, b.block_index * 8 AS block_start_h, b.block_index * 8 + 8 AS block_end_h, b.block_index * 8 + 8 AS prediction_time_h,
        coalesce(r.n, 0) AS dynamic_row_count, CAST(coalesce(sum(obs_count), 0) AS BIGINT) AS non_missing_measurements_in_block, count(l.variable) AS observed_variables_in_block, {wide}
        FROM blocks b LEFT JOIN (SELECT hospital_id, stay_id_global, block_index, count(DISTINCT row_ord) AS n FROM inblock GROUP BY ALL) r USING (hospital_id, stay_id_global, block_index)
        LEFT JOIN long l USING (hospital_id, stay_id_global, block_index) GROUP BY b.hospital_id, b.stay_id_global, b.block_index, r.n),
candidates AS (SELECT f.stay_id_global || '__b' || block_index || '__h' || horizon_h AS instance_id, f.hospital_id, f.stay_id_global, block_index, block_start_h, block_end_h, prediction_time_h, horizon_h, prediction_time_h + horizon_h AS future_window_end_h,
        icu_end_time_proxy_hours, non_missing_measurements_in_block AS feature_obs_count, non_missing_measurements_in_block > 0 AS has_feature_data_in_block, icu_end_time_proxy_hours >= prediction_time_h + horizon_h AS has_full_future_horizon,
        non_missing_measurements_in_block > 0 AND icu_end_time_proxy_hours >= prediction_time_h + horizon_h AS valid_instance,
        CASE WHEN non_missing_measurements_in_block = 0 THEN 'no_chapter1_feature_data_in_block' WHEN NOT icu_end_time_proxy_hours >= prediction_time_h + horizon_h THEN 'insufficient_future_followup' END AS exclusion_reason
        FROM features f JOIN exclusions e ON e.retained AND e.stay_id_global = f.stay_id_global, (VALUES (CAST(8 AS BIGINT)), (24)) h(horizon_h)),
labels_ AS (SELECT c.* EXCLUDE (valid_instance, exclusion_reason), icu_mortality AS label_value, icu_mortality IS NOT NULL AS label_available, '{label_name}' AS label_name, '{label_semantics}' AS label_semantics
        FROM candidates c JOIN exclusions e ON e.retained AND e.stay_id_global = c.stay_id_global WHERE valid_instance),
ready AS (SELECT l.instance_id, l.hospital_id, l.stay_id_global, l.block_index, l.block_start_h, l.block_end_h, l.prediction_time_h, l.horizon_h, l.label_value, {selected} FROM labels_ l JOIN features f USING (hospital_id, stay_id_global, block_index) WHERE label_available),
times AS (SELECT DISTINCT hospital_id, stay_id_global, time_us FROM obs WHERE variable IN ('purchase', 'error', 'signup') AND value IS NOT NULL),
runs AS (SELECT *, sum(new) OVER (PARTITION BY stay_id_global ORDER BY time_us) AS episode FROM
        (SELECT *, CASE WHEN time_us - lag(time_us) OVER (PARTITION BY stay_id_global ORDER BY time_us) <= 28800000000 THEN 0 ELSE 1 END AS new FROM times)),
episodes AS (SELECT hospital_id, stay_id_global, CAST(episode AS BIGINT) AS episode, min(time_us) AS start_us, max(time_us) AS end_us, count(*) AS timestamps, (max(time_us) - min(time_us)) / 3600000000.0 AS duration_h FROM runs GROUP BY ALL),
vqc AS (SELECT s.hospital_id, s.stay_id_global, coalesce((SELECT count(*) FROM times t WHERE t.stay_id_global = s.stay_id_global), 0) AS timestamps, coalesce(e.n, 0) AS episodes, coalesce(e.m, 0.0) AS max_duration_h, coalesce(e.m, 0.0) >= 24 AS passes
        FROM static s LEFT JOIN (SELECT stay_id_global, count(*) AS n, max(duration_h) AS m FROM episodes GROUP BY 1) e USING (stay_id_global)),
dstatic0 AS (SELECT hospital_id, stay_id_local, stay_id_global FROM static UNION ALL SELECT hospital_id, stay_id_local, stay_id_global FROM static WHERE CAST(stay_id_local AS BIGINT) % 29 = 0),
dstatic AS (SELECT hospital_id, CASE WHEN CAST(stay_id_local AS BIGINT) % 31 = 0 THEN NULL WHEN CAST(stay_id_local AS BIGINT) % 5 = 0 THEN '7' ELSE stay_id_local END AS stay_id_local, stay_id_global FROM dstatic0),
dobs AS (SELECT row_ord, hospital_id, CASE WHEN row_ord % 97 = 0 THEN NULL WHEN row_ord % 101 = 0 THEN 'none' ELSE stay_id_local END AS stay_id_local,
        CASE WHEN row_ord % 103 = 0 THEN stay_id_global || 'x' ELSE stay_id_global END AS stay_id_global, CASE WHEN row_ord % 89 = 0 THEN 0 ELSE time_us END AS time_us FROM obs),
rules(variable, hard_min, hard_max, invalid_zero) AS (VALUES ('click', 0.0, 150.0, false), ('error', 1.0, 120.0, false), ('purchase', NULL, 80.0, false), ('signup', 0.0, NULL, true), ('view', 2.0, 100.0, true)),
judged AS (SELECT o.*, coalesce(value < hard_min, false) OR coalesce(value > hard_max, false) OR (invalid_zero AND coalesce(value = 0, false)) AS bad FROM obs o JOIN rules USING (variable)),
acted AS (SELECT hospital_id, stay_id_local, stay_id_global, time_us, row_ord, variable, CASE WHEN hospital_id = 'site_4' AND variable = 'view' THEN value / 7.50062 WHEN hospital_id = 'site_6' AND variable = 'error' THEN NULL ELSE value END AS value FROM obs),
dist AS (SELECT *, q3 - q1 AS iqr, max - min AS range FROM (SELECT hospital_id, variable, count(*) AS n, min(value) AS min, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, max(value) AS max
        FROM obs WHERE value IS NOT NULL GROUP BY ALL HAVING count(*) >= 20)),
metric AS (SELECT hospital_id, variable, unnest([0, 1, 2, 3, 4]) AS i, unnest(['min', 'median', 'iqr', 'max', 'range']) AS metric, unnest([min, median, iqr, max, range]) AS x FROM dist),
fences AS (SELECT variable, metric, count(*) AS hospitals, quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM metric GROUP BY ALL HAVING count(*) >= 4),
issues AS (SELECT hospital_id, variable, hospitals, string_agg(metric, ',' ORDER BY i) AS flagged_metrics FROM metric JOIN fences USING (variable, metric) WHERE x < a - 1.5 * (b - a) OR x > b + 1.5 * (b - a) GROUP BY ALL),
rawstatic AS (SELECT c_custkey AS k, 'site_' || (c_custkey % 8) AS hospital_id, c_mktsegment FROM customer),
rawvalues AS (SELECT event_id, hospital_id, col, form, cents, CASE form WHEN 0 THEN '<' || (cents // 100) WHEN 1 THEN '> ' || (cents // 100) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') WHEN 2 THEN (cents // 100) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
        WHEN 3 THEN 'kein  Material' WHEN 4 THEN '1:2,5' WHEN 5 THEN '  ' WHEN 6 THEN 'abc' ELSE (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS text
        FROM (SELECT event_id, 'site_' || (user_id % 8) AS hospital_id, CASE WHEN event_type = 'click' THEN 'ie_ratio' ELSE event_type END AS col, event_id % 8 AS form, CAST(floor(value * 100) AS BIGINT) AS cents FROM events)),
parsed AS (SELECT *, CASE WHEN form = 7 THEN cents / 100.0 END AS plain, CASE WHEN form = 7 THEN cents / 100.0 WHEN form = 2 AND (col = 'ie_ratio' OR hospital_id = 'site_4') THEN cents / 100.0 WHEN form = 4 AND col = 'ie_ratio' THEN 0.4
        WHEN col <> 'ie_ratio' AND hospital_id = 'site_4' AND form = 0 THEN 0.0 WHEN col <> 'ie_ratio' AND hospital_id = 'site_4' AND form = 1 THEN cents / 100.0 END AS value FROM rawvalues)
"""


def base_sql() -> str:
    stats = ("mean", "median", "min", "max", "last")
    wide, selected = [], []
    for v in VARIABLES:
        wide.append(f"coalesce(max(obs_count) FILTER (l.variable = '{v}'), 0) AS {v}_obs_count")
        wide += [f"max({s}) FILTER (l.variable = '{v}') AS {v}_{s}" for s in stats]
        selected += [f"f.{v}_{s}" for s in ("obs_count", *stats)]
    satisfied = ", ".join(f"to_json(list_filter(string_split(max(satisfied_by) FILTER (physiologic_group = '{g}'), ','), lambda v: v <> '')) AS {g}_satisfied_by" for g in GROUPS)
    sql = BASE_SQL.replace("{satisfied}", satisfied).replace("{label_name}", LABEL_NAME).replace("{label_semantics}", LABEL_SEMANTICS)
    return sql.replace("{wide}", ", ".join(wide)).replace("{selected}", ", ".join(selected)).strip()
