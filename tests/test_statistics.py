"""Quartiles without a group in one task, one count of values for a report, tables that go."""

import os

import pytest
from pyspark.sql import functions as F

from stayflow.operators import quality
from stayflow.operators import statistics as S
from stayflow.plans import queries
from stayflow.sources import staging

FOLDER = "/root/testdata/sf0.001"


def test_values_close_together_are_spread(spark, monkeypatch):
    # a million different values within one percent, and others: all lie in one coarse step
    close = spark.range(1_000_000).select(F.lit("close").alias("g"), (37.0 + F.col("id") / 3e6).alias("v"), (F.col("id") % 3 + 1).alias("c"))
    tiny = spark.range(300_000).select(F.lit("tiny").alias("g"), (1.0 + F.pow(F.lit(2.0), -F.lit(20)) * F.pow(F.col("id") / 3e5, 6)).alias("v"), F.lit(1).cast("long").alias("c"))
    df = close.unionByName(tiny).withColumn("v", F.explode(F.array_repeat("v", F.col("c").cast("int")))).drop("c")
    ordered = []
    of_steps = S._of_steps
    monkeypatch.setattr(S, "_of_steps", lambda rows, steps, keys, columns: ordered.append((of_steps(rows, steps, keys, columns), "_v" in columns)) or ordered[-1][0])
    got = {r["g"]: (r["n"], r["min"], r["max"], list(r["_q"])) for r in S.spread(S.count_values(df, ["g"], "v"), ["g"], "v").collect()}
    want = df.groupBy("g").agg(F.count("*"), F.min("v"), F.max("v"), F.percentile("v", F.array(*[F.lit(p) for p in S.QUARTILES]))).collect()
    assert {g: (*x[:3], [pytest.approx(v, rel=1e-14) for v in x[3]]) for g, x in got.items()} == {r[0]: (r[1], r[2], r[3], list(r[4])) for r in want}
    last, splits = ordered[-1][0], sum(more for _, more in ordered)
    sizes = [r["count"] for r in last.groupBy("g", "_step").count().collect()]
    assert splits >= 1 and max(sizes) <= S.FULL and len(sizes) >= 4


def test_splitting_ends_with_extreme_values(spark, monkeypatch):
    monkeypatch.setattr(S, "FULL", 2)
    values = [0.0, -0.0, 5e-324, 1e-323, 1.7e308, 1.6e308, -1.7e308, float("inf"), float("-inf"), float("nan"), 1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0 + 2**-50, 1.0 + 3 * 2**-51]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0 + i * 2**-52) for i in range(100)] + [(None, None)], "g string, v double")
    got = {r["g"]: r["_q"] for r in S.spread(S.count_values(df, ["g"], "v"), ["g"], "v").collect()}
    want = df.where("g = 'b'").agg(F.percentile("v", F.array(*[F.lit(p) for p in S.QUARTILES]))).first()[0]
    assert got["b"] == [pytest.approx(v, rel=1e-15) for v in want] and got["a"][1] == 1.0 + 2**-52 and set(got) == {"a", "b"}


SCANS = {"numeric_summary": 1, "describe_by_hospital": 1, "semantic_decisions": 1, "distribution_summary": 1, "distribution_issues": 1, "invalid_value_qc": 1, "stay_id_summary": 1, "non_numeric_issues": 1, "model_ready": 2, "candidate_instances": 2, "blocked_features_long": 2, "stay_exclusions": 1}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_reads_of_events_and_no_table_left(spark, monkeypatch, name):
    """Over all plans of a query, those that are written included: reads of the events, no Python, no Cartesian product; then nothing stays."""
    plans = []
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    for module in (queries, quality, S, staging):
        write = module.stage
        monkeypatch.setattr(module, "stage", lambda df, tag, f=write: f(planned(df), tag))
    folder = staging.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with staging.lifetime(spark):
        planned(queries.QUERIES[name](spark, FOLDER)).collect()
        assert not plans[:-1] or set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before
    assert sum(p.count("events.parquet") for p in plans) == SCANS[name]
    assert not any(w in p for p in plans for w in ("Python", "Arrow", "CartesianProduct"))


def test_lifetimes_nest(spark):
    df = spark.range(3)
    folder = staging.shared_folder(spark).removeprefix("file:")
    with staging.lifetime(spark):
        kept = staging.stage(df, "outer")
        with pytest.raises(ZeroDivisionError), staging.lifetime(spark):
            staging.stage(df, "inner")
            assert sum(n.startswith(("inner", "outer")) for n in os.listdir(folder)) == 2
            raise ZeroDivisionError
        assert kept.count() == 3 and not [n for n in os.listdir(folder) if n.startswith("inner")]
    assert not [n for n in os.listdir(folder) if n.startswith("outer")]
