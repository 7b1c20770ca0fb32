import pytest

import __spark_entry__ as entry
from pitlake.plans.catalog import ORACLES, QUERIES

from helpers import duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, duck, name):
    assert spark_rows(QUERIES[name](spark, sf)) == duck_rows(duck, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_as_of_is_one_shuffle_and_no_join(spark, sf):
    from pitlake.operators.temporal import as_of_join
    from pyspark.sql import functions as F

    e = spark.read.parquet(f"{sf}/events.parquet")
    out = as_of_join(e.select("event_id", "user_id", "ts"), e.select("user_id", "ts", "value", F.col("event_id").alias("tie")), ["user_id"], "ts", "ts", ["value"], "tie")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("hashpartitioning") == 1


def test_no_nested_loops(spark, sf):
    for name in ("interval_lookup_unique", "overlap_collisions", "alert_pairing", "nearest_event", "membership_3valued", "cluster_buys"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
