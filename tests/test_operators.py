"""Small hand-made cases of the operators."""

import pytest
from pyspark.sql import functions as F

from stayflow.functions import expressions as X
from stayflow.operators import blocks, cohort, harmonize, identity, instances, quality, ventilation
from stayflow.plans import fixed, layers
from stayflow.sources import layers as L
from stayflow.sources import raw

HOUR = X.HOUR_US


def one(spark, make, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(make("c")).collect()]


def test_ratio(spark):
    got = one(spark, X.ie_ratio, ["1/1.5", "1.5/1", "1:1.5", "1:2,6", "0.769", "0,769", "not_a_ratio", "1:0", None, ""])
    assert [None if g is None else round(g, 4) for g in got] == [0.6667, 1.5, 0.6667, 0.3846, 0.769, 0.769, None, None, None, None]


def test_laboratory(spark):
    words = ["<0.15", "storniert", "storno", "kein Material", "falsches Mater.", "fal.Volumen", "geronnen", "entfällt", "Folgt", ">50000.0", ">6,5", "2,4", "x", None]
    assert one(spark, X.laboratory, words) == [0.0, *[None] * 8, 50000.0, 6.5, 2.4, None, None]


def test_number_is_strict(spark):
    assert one(spark, X.number, ["1.5", " 2 ", "1d", "NaN", "1e3", ".5", "5.", "", None, "1,5"]) == [1.5, 2.0, None, None, 1000.0, 0.5, 5.0, None, None, None]


def test_stay_ids(spark):
    assert one(spark, X.local_stay_id, ["0012", "9990.0", "1e3", "-0", "abc ", "1.50", None, " "]) == ["12", "9990", "1000", "0", "abc", "1.5", None, None]
    assert one(spark, lambda c: X.global_stay_id(F.lit("h"), c), ["1", None]) == ["h_1", None]


def test_time_spans(spark):
    assert one(spark, X.time_us, ["1 days 00:15:00", "00:15:00", "1 day", "-1h", "15 min", "soon", None]) == [24 * HOUR + HOUR // 4, HOUR // 4, 24 * HOUR, -HOUR, HOUR // 4, None, None]
    assert one(spark, X.time_text, [HOUR // 4, 25 * HOUR], "long") == ["0 days 00:15:00", "1 days 01:00:00"]


def stays(spark, rows):
    return spark.createDataFrame(rows, "hospital_id string, stay_id_global string, icu_end_us long")


def obs(spark, rows):
    return spark.createDataFrame(rows, "hospital_id string, stay_id_global string, time_us long, row_ord long, variable string, value double")


def test_block_counts(spark):
    s = 1_000_000
    counts = blocks.stay_block_counts(stays(spark, [("A", "1", 8 * HOUR - s), ("A", "2", 8 * HOUR), ("A", "3", 24 * HOUR - s), ("A", "4", 24 * HOUR), ("A", "5", None), ("A", "6", -HOUR)]))
    got = {r["stay_id_global"]: (r["block_count"], r["ends_on_boundary"]) for r in counts.collect()}
    assert got == {"1": (0, False), "2": (1, True), "3": (2, False), "4": (3, True), "5": (0, False), "6": (0, False)}
    assert blocks.block_index(counts).count() == 6
    blocks.check_blocks(blocks.block_validation(counts, blocks.block_index(counts)))


def test_blocked_features(spark):
    counts = blocks.stay_block_counts(stays(spark, [("A", "A_1", 24 * HOUR), ("A", "A_2", 8 * HOUR)]))
    o = obs(spark, [("A", "A_1", HOUR, 0, "hr", 100.0), ("A", "A_1", 2 * HOUR, 1, "hr", 110.0), ("A", "A_1", HOUR, 0, "sbp", 120.0), ("A", "A_1", 24 * HOUR, 2, "hr", 1.0), ("A", "A_1", -HOUR, 3, "hr", 1.0), ("A", "A_1", 3 * HOUR, 4, "hr", None)])
    rows = {(r["stay_id_global"], r["block_index"]): r for r in blocks.blocked_features(blocks.in_blocks(o, counts), counts, ["hr", "sbp"]).collect()}
    assert set(rows) == {("A_1", 0), ("A_1", 1), ("A_1", 2), ("A_2", 0)}
    r = rows["A_1", 0]
    assert [r[f"hr_{s}"] for s in blocks.STATISTICS] == [2, 105.0, 105.0, 100.0, 110.0, 110.0] and r["sbp_obs_count"] == 1
    assert (r["dynamic_row_count"], r["non_missing_measurements_in_block"], r["observed_variables_in_block"]) == (3, 3, 2)
    empty = rows["A_2", 0]
    assert empty["hr_obs_count"] == 0 and empty["hr_mean"] is None and empty["dynamic_row_count"] == 0
    assert blocks.negative_time_qc(o).collect()[0]["rows"] == 1


def test_episodes(spark):
    at = {"A_1": (0, 8, 16, 24, 36), "A_2": (0, 7, 16.5, 23)}
    o = obs(spark, [("A", s, int(h * HOUR), i, "peep", 5.0) for s, hs in at.items() for i, h in enumerate(hs)] + [("B", "B_3", 0, 0, "hr", 1.0)])
    times = ventilation.supported_times(o, ["peep"])
    qc = {r["stay_id_global"]: (r["timestamps"], r["episodes"], r["max_duration_h"], r["passes"]) for r in ventilation.stay_qc(o, times, ventilation.episodes(times)).collect()}
    assert qc == {"A_1": (5, 2, 24.0, True), "A_2": (4, 2, 7.0, False), "B_3": (0, 0, 0.0, False)}
    with pytest.raises(ValueError):
        ventilation.check_times(obs(spark, [("A", "A_1", None, 0, "peep", 5.0)]), ["peep"])


def test_static_recodes(spark):
    df = spark.createDataFrame([("1", "X", "Z", "unknown", "weird")], ["PseudoID", "clusterGeschlecht", "BMI", "Entlassgrund_(verlegt_intern,_verlegt_extern,_verstorben)", "Sterblichkeit"])
    r = harmonize.harmonize_static(df, "asic_TEST").first()
    assert (r["stay_id_local"], r["stay_id_global"], r["hosp_mortality"], r["icu_mortality"], r["icu_los"]) == ("1", "asic_TEST_1", None, None, None)
    assert {x["column"] for x in harmonize.unexpected_categories(df, "asic_TEST").collect()} == {"sex", "bmi_group", "hosp_mortality", "icu_mortality"}
    assert list(r.asDict()) == fixed.STATIC_COLUMNS


def test_alias_conflicts(spark):
    df = spark.createDataFrame([("1", "1"), ("2", None)], ["PseudoID", "Pseudo-ID"])
    with pytest.raises(ValueError):
        harmonize.check_aliases(df, {"stay_id_local": ["Pseudo-ID", "PseudoID"]})
    assert [x[0] for x in df.select(harmonize.merged(df, ["Pseudo-ID", "PseudoID"])).collect()] == ["1", "2"]


def test_column_order_covers_every_variable():
    assert len(fixed.dynamic_columns()) == 107 and len(fixed.INVALID_VALUE_RULES) == 44


def test_invalid_values(spark):
    rules = quality.rules_table(spark, [("a", 0.0, 10.0, True), ("b", None, None, False)])
    o = obs(spark, [("h", "s", 0, i, "a", v) for i, v in enumerate([0.0, 10.0, 10.5, -1.0, 5.0, None])] + [("h", "s", 0, 9, "z", 1e9)])
    assert sorted(r["value"] for r in quality.clean_invalid(o, rules).where("value IS NOT NULL").collect()) == [5.0, 10.0, 1e9]
    qc = {r["variable"]: r for r in quality.invalid_value_qc(o, rules, o).collect()}
    assert (qc["a"]["non_null_before"], qc["a"]["invalid_count"], qc["a"]["dominant_site"]) == (5, 3, "h")
    assert (qc["b"]["non_null_before"], qc["b"]["invalid_proportion"], qc["b"]["dominant_site"]) == (0, 0.0, None)


def test_identity_gate(spark):
    static = spark.createDataFrame([("asic_A", "1", "asic_A_1")] * 2, "hospital_id string, stay_id_local string, stay_id_global string")
    rows = [("asic_A", "1", "asic_A_1", 0), ("asic_A", "1", "asic_A_1", 0), ("asic_B", "9", "asic_B_9", 0), ("asic_A", None, None, 24 * HOUR)]
    o = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "hospital_id string, stay_id_local string, stay_id_global string, time_us long, row_ord long")
    assert identity.static_duplicates(static).first()["duplicate_count"] == 2
    assert identity.mapping_failures(static, o).count() == 4 and identity.missing_id_rows(static, o).count() == 1 and identity.duplicate_time_rows(o).count() == 2
    with pytest.raises(ValueError):
        identity.check_stay_ids(static, o)


def test_site_needs_outcome_and_groups(spark):
    s = spark.createDataFrame([("A", "A_1", 0, 1), ("A", "A_2", 1, 0), ("B", "B_1", 0, None)], "hospital_id string, stay_id_global string, readmission long, icu_mortality long").withColumn("icu_end_time_proxy_hours", F.lit(20.0))
    o = obs(spark, [(h, f"{h}_1", 0, i, v, 1.0) for h in "AB" for i, v in enumerate(["heart_rate", "sbp", "sao2"])])
    groups = cohort.group_table(spark, fixed.VITAL_GROUPS, fixed.OPTIONAL_GROUPS)
    sites = {r["hospital_id"]: r for r in cohort.site_eligibility(s, o, groups).collect()}
    assert sites["A"]["site_included"] and not sites["B"]["site_included"] and sites["B"]["exclusion_reason"] == "missing/unusable icu_mortality"
    assert sites["A"]["usable_groups"] == 3 and sites["A"]["missing_groups"] == "respiratory"
    status = {r["stay_id_global"]: (r["status"], r["exclusion_reason"]) for r in cohort.stay_exclusions(s, o, cohort.site_eligibility(s, o, groups)).collect()}
    assert status == {"A_1": ("retained", ""), "A_2": ("excluded_stay", "no dynamic data; readmission flagged"), "B_1": ("excluded_site", "")}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def export(root):
    for site, ids in (("UK_00", (11, 12)), ("UK_01", (21,))):
        write(root / site / "static/andere_variablen_kds_patienten.csv", "PseudoID;clusterGeschlecht;Sterblichkeit;Wiederaufnahme_ICU\n" + "".join(f"{i};W;0;0\n" for i in ids))
    for i in (11, 12):
        write(root / f"UK_00/dynamic_filtered/{i}.csv", "Zeit_ab_Aufnahme,HF,SAP,AF,SpO2\n" + "".join(f"{m},{80 + m // 60},120,15,97\n" for m in range(15, 1600, 60)))
    write(root / "UK_00/dynamic/dynamische_variablen_kds_patient_99.csv", "Zeit_ab_Aufnahme;HF\n15;1\n")
    write(root / "UK_01/dynamic/dynamische_variablen_kds_patient_21.csv", "HF;PEEP;CRP;Zeit_ab_Aufnahme\n80;4,75;storno;15\n82;5,5;storniert;30\n")


def test_raw_exports(spark, tmp_path):
    export(tmp_path)
    folders = raw.site_folders(spark, str(tmp_path))
    assert [raw.hospital_name(f) for f in folders] == ["asic_UK00", "asic_UK01"]
    assert raw.dynamic_layout(spark, folders[0]) == "dynamic_filtered"
    with pytest.raises(FileNotFoundError):
        raw.dynamic_layout(spark, str(tmp_path))
    rows = raw.load_all(spark, str(tmp_path), "dynamic").orderBy("stay_id_local", F.col("minutes_since_admit").cast("int"))
    last = rows.where("hospital_id = 'asic_UK01'").select("stay_id_local", "time", "peep", "crp").collect()
    assert [tuple(r) for r in last] == [("21", "0 days 00:15:00", "4.75", None), ("21", "0 days 00:30:00", "5.5", None)]
    assert raw.load_static(spark, folders[0]).first()["Pseudo-ID"] == "11"


def told(df):
    return sorted(str(r.asDict()) for r in df.collect())


def test_layers_rebuilt_from_files_are_equal(spark, tmp_path):
    export(tmp_path / "raw")
    first = layers.harmonized(spark, str(tmp_path / "raw"), min_non_null=1)
    assert first["static"].count() == 3 and first["dynamic"].where("variable = 'heart_rate'").count() == 56
    wide = first["dynamic_wide"].where("hospital_id = 'asic_UK01'").orderBy("time_us").collect()
    assert [(r["heart_rate"], r["peep"], r["crp"]) for r in wide] == [(80.0, 4.75, None), (82.0, 5.5, None)]
    assert first["dynamic"].select("row_ord").distinct().count() == 56
    lineage = {(r["hospital_id"], r["canonical_name"]): r["raw_columns"] for r in first["dynamic_source_map"].collect()}
    assert lineage["asic_UK00", "sbp"] == "SAP" and lineage["asic_UK01", "peep"] == "PEEP" and lineage["asic_UK01", "sbp"] == ""
    assert first["non_numeric_issues"].count() == 0 and first["static_schema_summary"].count() == 2
    direct = layers.standardized(first["static"], first["dynamic"])
    paths = layers.write_harmonized(first, str(tmp_path / "layer"))
    assert len(paths) == 26
    rebuilt = layers.rebuild_standardized(spark, str(tmp_path / "layer"))
    assert set(direct) == set(rebuilt) and len(direct) == 12
    for name in direct:
        assert told(direct[name]) == told(rebuilt[name]), name
    layers.write_standardized(rebuilt, str(tmp_path / "layer"))
    layers.write_model_ready(layers.model_ready(first["static"], rebuilt["stay_level"], first["dynamic"], rebuilt["blocked_features"]), str(tmp_path / "model"), "parquet")
    inputs = L.load_layer(spark, str(tmp_path / "layer"), fmt="csv")
    assert set(inputs) == {*L.MODEL_INPUTS, *L.MODEL_OPTIONAL}
    lines = [line for p in sorted((tmp_path / "layer/cohort/stay_level.csv").glob("part-*")) for line in p.read_text().splitlines()[1:]]
    assert [line.split(",")[0] for line in lines] == sorted(line.split(",")[0] for line in lines)
    ready = L.load_layer(spark, str(tmp_path / "model"), ["model_ready/chapter1_model_ready_dataset", "model_ready/chapter1_feature_set"], ())
    assert ready["model_ready/chapter1_model_ready_dataset"].count() > 0 and ready["model_ready/chapter1_feature_set"].count() == 48
    with pytest.raises(FileNotFoundError):
        L.load_layer(spark, str(tmp_path / "layer"), ["nothing"])
    with pytest.raises(ValueError):
        L.write_table(first["static"], str(tmp_path / "x"), "xml")
    with pytest.raises(KeyError):
        layers.write_standardized({"stay_level": first["static"]}, str(tmp_path / "y"))


def test_restricted_cohort_and_its_blocks(spark, tmp_path):
    export(tmp_path / "raw")
    first = layers.harmonized(spark, str(tmp_path / "raw"), min_non_null=1)
    stays = layers.standardized(first["static"], first["dynamic"])["stay_level"]
    raw_outcome = spark.createDataFrame([("asic_UK00", "0"), ("asic_UK01", None)], "hospital_id string, raw_outcome string")
    provenance = cohort.outcome_provenance(first["static"], first["static_source_map"], raw_outcome)
    tables = layers.restricted(first["static"], stays, first["dynamic"], provenance=provenance)
    kept = layers.restricted_blocks(tables["retained_stays"], stays, first["dynamic"])
    assert {r[0] for r in tables["retained_stays"].select("hospital_id").collect()} == {"asic_UK00"}
    assert {r[0] for r in kept["block_index"].select("hospital_id").collect()} == {"asic_UK00"} and kept["stay_block_counts"].count() == 2
    assert tables["retained_table"].where("block_count = 3 AND sex = 'F'").count() == 2
    layers.write_restricted(tables | kept, str(tmp_path / "restricted"), "parquet")
    lost = cohort.outcome_provenance(first["static"].withColumn("icu_mortality", F.lit(None).cast("long")), first["static_source_map"], raw_outcome)
    assert {r["hospital_id"]: r["status"] for r in lost.collect()} == {"asic_UK00": "raw_values_lost", "asic_UK01": "verified_raw_icu_mortality_source_present_but_all_missing"}
    with pytest.raises(ValueError):
        layers.restricted(first["static"], stays, first["dynamic"], provenance=lost)
    with pytest.raises(ValueError):
        cohort.check_cohort(tables["retained_stays"], tables["stay_exclusions"], tables["site_eligibility"].withColumn("site_included", F.lit(False)))


def test_gates_stop_the_harmonized_layer(spark, tmp_path):
    export(tmp_path)
    table = tmp_path / "UK_00/static/andere_variablen_kds_patienten.csv"
    table.write_text("PseudoID;clusterGeschlecht;ClusterGeschlecht\n11;W;W\n12;W;M\n", encoding="utf-8")
    with pytest.raises(ValueError, match="aliases clusterGeschlecht and ClusterGeschlecht disagree"):
        raw.load_all(spark, str(tmp_path), "static")
    table.write_text("PseudoID;clusterGeschlecht\n11;W\n12;W\n", encoding="utf-8")
    write(tmp_path / "UK_01/dynamic/dynamische_variablen_kds_patient_21.csv", "HF;PEEP;Time\n80;4,75;soon\n")
    with pytest.raises(ValueError, match="supported rows without a time"):
        layers.harmonized(spark, str(tmp_path))


def test_another_translation(spark, tmp_path):
    export(tmp_path / "raw")
    write(tmp_path / "names.json", '{"dynamic": {"HF": "sbp", "Zeit_ab_Aufnahme": "minutes_since_admit", "Time": "time", "PseudoID": "stay_id"}}')
    names = raw.read_translation(spark, str(tmp_path / "names.json"))["dynamic"]
    rows = raw.load_all(spark, str(tmp_path / "raw"), "dynamic", names)
    assert rows.where("sbp IS NOT NULL").count() == 56 and "heart_rate" not in rows.columns


def test_quartiles_equal_a_plain_percentile(spark):
    from stayflow.operators import statistics as S

    rows = [(g, v) for g, vs in {"a": [0.0, -1.5, 3.25, 1e9, -1e-9, 7.0, 7.0, None], "b": [2.0], "c": [None], None: [5.0, 6.0], "d": [float(i % 97) / 7 - 3 for i in range(500)]}.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["n"], r["min"], r["max"], [round(x, 9) for x in r["_q"]]) for r in S.spread(S.count_values(df, ["g"], "v"), ["g"], "v").collect()}
    want = df.where("v IS NOT NULL").groupBy("g").agg(F.count("v"), F.min("v"), F.max("v"), F.percentile("v", F.array(*[F.lit(p) for p in S.QUARTILES]))).collect()
    assert got == {r[0]: (r[1], r[2], r[3], [round(x, 9) for x in r[4]]) for r in want}
    assert [r["_first"] for r in S.first_values(df.where("g = 'a'"), ["g"], "v", 3).collect()] == [[-1.5, -1e-9, 0.0]]


def test_csv_keeps_nested_values_as_json(spark, tmp_path):
    df = spark.createDataFrame([(1, [3, 1], {"a": 1})], "k int, l array<int>, m map<string,int>")
    L.write_table(df, str(tmp_path / "t.csv"), "csv")
    L.append_csv(df, str(tmp_path / "t.csv"))
    with pytest.raises(ValueError):
        L.append_csv(df.drop("l"), str(tmp_path / "t.csv"))
    assert [tuple(r) for r in L.read_table(spark, str(tmp_path / "t.csv")).collect()] == [("1", "[3,1]", '{"a":1}')] * 2
    L.write_dynamic_by_hospital(spark.createDataFrame([("A", "s"), ("B", "t")], "hospital_id string, stay_id_global string"), spark.createDataFrame([("s",)], "stay_id_global string"), str(tmp_path / "p"))
    assert [r["hospital_id"] for r in spark.read.parquet(str(tmp_path / "p")).collect()] == ["A"]


def test_static_texts_are_trimmed_once_in_code_that_is_compiled(spark):
    from stayflow.plans import queries

    plan = queries.QUERIES["static_harmonized"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("regexp_replace") < 20
    stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
    assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000


def test_static_texts_with_odd_blanks(spark):
    blanks = ["", " ", "\t\x0b", "\r\n"]
    values = {"sex": (" w\u2028", "W\u2028"), "icu_los": ("12.0", 12), "icu_readmit": ("1.5", None), "vent_free_days": ("-1.0", None), "hosp_los": ("-2", -2), "stay_id_local": ("0012.50", "12.5"), "bmi_group": ("nan", None), "weight_group": ("-1", None), "age_group": ("a  b", "a  b")}
    raw = spark.createDataFrame([tuple(x + v + y for v, _ in values.values()) for x in blanks for y in blanks], list(values))
    rows = harmonize.harmonize_static(raw, "h", {c: [c] for c in values}).select(*values).collect()
    assert len(rows) == 16 and {tuple(r) for r in rows} == {tuple(v for _, v in values.values())}
