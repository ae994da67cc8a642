"""The gate and the summary of stay ids."""

import pytest

from stayflow.operators import identity
from stayflow.plans import queries

FOLDER = "/root/testdata/sf0.001"
DAY = 24 * 3_600_000_000
STATIC, OBS = "hospital_id string, stay_id_local string, stay_id_global string", "hospital_id string, stay_id_local string, stay_id_global string, time_us long, row_ord long"


def tables(spark):
    static = spark.createDataFrame([("asic_A", "1", "asic_A_1")] * 2 + [("asic_A", None, "asic_A_n"), ("asic_B", None, "asic_B_n"), ("asic_C", "1", "asic_C_1")], STATIC)
    rows = [("asic_A", "1", "asic_A_1", 0), ("asic_A", "1", "asic_A_1", 0), ("asic_B", "9", "asic_B_9", 0), ("asic_A", None, None, DAY), ("asic_C", "1", "asic_C_1", 0), ("asic_C", "1", "other", DAY), ("asic_C", "1", None, DAY)]
    return static, spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], OBS)


def test_metrics(spark):
    got = {r["metric"]: r["value"] for r in identity.stay_id_summary(*tables(spark)).collect()}
    assert list(got.values()) == [5, 4, 3, 1, 4, 3, 2, 4] and list(got) == list(identity.METRICS)


def test_reports_keep_times_and_null_ids(spark):
    static, obs = tables(spark)
    assert {tuple(r) for r in identity.missing_id_rows(static, obs).collect()} == {("static", "asic_A", None, "asic_A_n", None), ("static", "asic_B", None, "asic_B_n", None), ("dynamic", "asic_A", None, None, DAY)}
    assert sorted(map(tuple, identity.local_id_collisions(static).collect()), key=str) == sorted(
        [("1", "asic_A", "asic_A_1", 2), ("1", "asic_C", "asic_C_1", 2), (None, "asic_A", "asic_A_n", 2), (None, "asic_B", "asic_B_n", 2)], key=str
    )
    failures = {(r["row_ord"], r["reason"], r["time_us"]) for r in identity.mapping_failures(static, obs).collect()}
    assert failures == {(0, "ambiguous_static_mapping", 0), (1, "ambiguous_static_mapping", 0), (2, "missing_static_match", 0), (5, "mismatched_stay_id_global", DAY)}


def test_one_error_names_every_failure(spark):
    with pytest.raises(ValueError) as e:
        identity.check_stay_ids(*tables(spark))
    for part in ("observations without their stay (4)", "rows without an id (3)", "repeated stays (2)", "repeated times (4)"):
        assert part in str(e.value)
    good = spark.createDataFrame([("A", "1", "A_1"), ("A", "2", "A_2")], STATIC)
    identity.check_stay_ids(good, spark.createDataFrame([("A", "1", "A_1", 0, 0), ("A", "1", "A_1", 1, 1)], OBS))
    with pytest.raises(ValueError, match="^stay ids: repeated times"):
        identity.check_stay_ids(good, spark.createDataFrame([("A", "1", "A_1", 0, 0), ("A", "1", "A_1", 0, 1)], OBS))
    identity.check_stay_ids(good, spark.createDataFrame([], OBS))


def test_the_summary_reads_observations_once(spark):
    plan = queries.QUERIES["stay_id_summary"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1


def test_stays_are_counted_in_both_tables(spark):
    static, obs = tables(spark)
    assert {tuple(r) for r in identity.unique_stays_per_hospital(static, obs).select("hospital_id", "stays", "static_stays").collect()} == {("asic_A", 2, 2), ("asic_B", 2, 1), ("asic_C", 2, 1)}
    assert {tuple(r) for r in identity.unique_stays_per_hospital(static).collect()} == {("asic_A", 2), ("asic_B", 1), ("asic_C", 1)}
    plan = queries.QUERIES["unique_stays_per_hospital"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1 and plan.count("customer.parquet") == 2
