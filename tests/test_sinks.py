"""What a sink promises: order, lists and sets, hospitals rewritten alone, observations kept by stay."""

import pytest
from pyspark.sql import functions as F
from test_operators import export, told

from stayflow.operators import blocks, cohort
from stayflow.plans import fixed, layers
from stayflow.sources import layers as L


def lines(path):
    return [line for p in sorted(path.glob("part-*")) for line in p.read_text().splitlines()[1:]]


def test_lists_keep_their_order_and_sets_are_sorted(spark, tmp_path):
    df = spark.createDataFrame([([3, 1, 2], ["b", "a"], [[2], [1]])], "l array<int>, s array<string>, n array<array<int>>").select("l", L.as_set("s"), "n")
    L.write_table(df, str(tmp_path / "t.csv"), "csv")
    assert [tuple(r) for r in L.read_table(spark, str(tmp_path / "t.csv")).collect()] == [("[3,1,2]", '["a","b"]', "[[2],[1]]")]


def test_tables_are_written_in_their_own_order(spark, tmp_path):
    rows = [(24, "a", 1), (8, "c", 2), (8, "b", 9), (8, "a", 2), (None, "a", 5)]
    L.write_layer({"instance_exclusions": spark.createDataFrame(rows, "horizon_h int, exclusion_reason string, n int").repartition(3)}, str(tmp_path), "csv")
    assert lines(tmp_path / "instance_exclusions.csv") == ["8,b,9", "8,a,2", "8,c,2", "24,a,1", '"",a,5' if lines(tmp_path / "instance_exclusions.csv")[-1].startswith('"') else ",a,5"]
    issues = [("x", "c1", 0, 5), ("y", "c1", 3, 4), ("x", "c2", 3, 4), ("x", "c1", 3, 9)]
    L.write_layer({"non_numeric_issues": spark.createDataFrame(issues, "hospital_id string, column string, unresolved int, non_numeric int").repartition(3)}, str(tmp_path), "csv")
    assert lines(tmp_path / "non_numeric_issues.csv") == ["x,c1,3,9", "x,c2,3,4", "y,c1,3,4", "x,c1,0,5"]
    made = [t for group in (L.HARMONIZED, L.STANDARDIZED, L.RESTRICTED, L.MODEL_READY) for tables in group.values() for _, t in tables]
    assert set(L.ORDERS) <= set(made)


def test_declared_orders_name_columns_of_their_tables(spark, tmp_path):
    export(tmp_path / "raw")
    first = layers.harmonized(spark, str(tmp_path / "raw"), min_non_null=1)
    second = layers.standardized(first["static"], first["dynamic"])
    third = layers.model_ready(first["static"], second["stay_level"], first["dynamic"], second["blocked_features"])
    for name, df in (first | second | third).items():
        assert {k.removeprefix("-") for k in L.ORDERS.get(name, ())} <= set(df.columns), name
    restricted = layers.restricted(first["static"], second["stay_level"], first["dynamic"], provenance=cohort.outcome_provenance(first["static"]))
    assert {"stay_level", "stay_summary", "proxy_summary_by_hospital", "coding_distribution"} <= set(restricted)
    site = restricted["site_eligibility"].where("hospital_id = 'asic_UK01'").first()
    assert site["exclusion_reasons"] == ["insufficient core-vitals coverage"] and site["cardiac_rate_satisfied_by"] == ["heart_rate"] and site["blood_pressure_satisfied_by"] == []
    assert site["outcome_status"] == "verified_non_missing_harmonized_icu_mortality" and "core_temp_optional_satisfied_by" in restricted["site_eligibility"].columns
    stay = restricted["stay_exclusions"].where("hospital_id = 'asic_UK01'").first()
    assert stay["site_exclusion_reasons"] == ["insufficient core-vitals coverage"] and stay["stay_exclusion_reasons"] == [] and not stay["first_stay_proxy_eligible"] and stay["has_dynamic_data"]
    label = third["labels"].first()
    assert label["label_name"] == "terminal_icu_mortality" and label["future_window_end_h"] == label["prediction_time_h"] + label["horizon_h"] and label["has_full_future_horizon"]


def observations(spark, value=1.0):
    rows = [(h, f"{h}_{i}", str(i), t * blocks.BLOCK_US // 4, t, v, value + i) for h in "AB" for i in range(20) for t in range(9) for v in fixed.MODEL_VARIABLES[:2]]
    return spark.createDataFrame(rows, "hospital_id string, stay_id_global string, stay_id_local string, time_us long, row_ord long, variable string, value double")


def stays(spark):
    rows = [(h, f"{h}_{i}", str(i), 0, 0) for h in "AB" for i in range(20)]
    df = spark.createDataFrame(rows, "hospital_id string, stay_id_global string, stay_id_local string, icu_mortality long, icu_readmit long")
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("long" if c in fixed.STATIC_NUMBERS else "string").alias(c) for c in fixed.STATIC_COLUMNS])


def test_observations_kept_by_stay_are_not_shuffled(spark, monkeypatch):
    tables = L.save_layer_by_stay(stays(spark), observations(spark), "kept", 4)
    monkeypatch.setattr(L, "BUCKETS", 4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plans = {}
        write = layers.stage
        monkeypatch.setattr(layers, "stage", lambda df, tag: plans.setdefault(tag, df._jdf.queryExecution().executedPlan().toString()) and write(df, tag))
        rebuilt = layers.rebuild_standardized_by_stay(spark, "kept", fixed.MODEL_VARIABLES[:2])
        for tag in ("stay-level", "in-blocks"):
            assert "kept.dynamic" in plans[tag]
        # neither the ends of the stays nor their blocks move the observations: only the small side of a join is dealt out
        assert plans["stay-level"].count("Exchange") == 0 and plans["in-blocks"].count("Exchange") == 1
        assert plans["in-blocks"].split("Exchange")[0].count("kept.dynamic") == 1
        direct = layers.standardized(stays(spark), observations(spark), fixed.MODEL_VARIABLES[:2])
        for name in direct:
            assert told(direct[name]) == told(rebuilt[name]), name
        # one hospital is written anew, the other stays as it is
        L.replace_hospitals(observations(spark, 100.0).where("hospital_id = 'B'"), "kept.dynamic")
        spark.catalog.refreshTable("kept.dynamic")
        assert {r[0]: (r[1], r[2]) for r in spark.table("kept.dynamic").groupBy("hospital_id").agg(F.min("value"), F.count("*")).collect()} == {"A": (1.0, 360), "B": (100.0, 360)}
        assert tables["static"].count() == 40
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql("DROP DATABASE kept CASCADE")


def test_hospitals_are_rewritten_alone(spark, tmp_path):
    path = str(tmp_path / "p")
    L.write_dynamic_by_hospital(observations(spark), stays(spark), path)
    L.write_dynamic_by_hospital(observations(spark, 50.0).where("hospital_id = 'A'"), stays(spark), path, replace=True)
    assert {r[0]: (r[1], r[2]) for r in spark.read.parquet(path).groupBy("hospital_id").agg(F.min("value"), F.count("*")).collect()} == {"A": (50.0, 360), "B": (1.0, 360)}
    with pytest.raises(ValueError, match="without a hospital"):
        L.write_dynamic_by_hospital(observations(spark).withColumn("hospital_id", F.lit(None).cast("string")), stays(spark), path, replace=True)
