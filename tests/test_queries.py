"""Every registered query of the base library against its SQL."""

import pytest
from compare import connect, same

from stayflow.plans import queries

FOLDER = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    same(queries.QUERIES[name](spark, FOLDER), con, SQL[name])


def test_model_ready_reads_events_twice(spark, monkeypatch):
    plans = []
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    write = queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, tag: write(planned(df), tag))
    planned(queries.QUERIES["model_ready"](spark, FOLDER))
    assert sum(p.count("events.parquet") for p in plans) == 2


def test_most_customers_are_stays_without_an_end(spark):
    counts = {r["metric"]: r["value"] for r in queries.QUERIES["stay_summary"](spark, FOLDER).collect()}
    assert counts["rows"] == spark.read.parquet(f"{FOLDER}/customer.parquet").count() and counts["without_end"] > 0


def test_no_python_and_no_cartesian_product_in_plans(spark):
    for name in ("blocked_features_long", "vent_episodes", "distribution_summary", "model_ready"):
        plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan, name


def test_events_are_pruned_at_the_scan(spark):
    plan = queries.QUERIES["end_time_proxy"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema:")[1].split(">")[0]
    assert "ts" in schema and "user_id" in schema and "props" not in schema and "value" not in schema
