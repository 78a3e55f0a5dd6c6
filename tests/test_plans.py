"""Plan shapes: what must not be in a plan, and what must reach the scan."""

import pytest
from oracle import DATA

from pyspark.sql import functions as F

from tidemark.operators import identity as I
from tidemark.plans import relational, views
from tidemark.registry import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["e8_j8_blocked_pairs", "e11_clusters", "j10_signature_lookup", "j4_alternatives", "e12_interlink_same_key", "search_cascade"])
def test_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_identity_is_native(spark):
    df = spark.createDataFrame([("Dolo 650", "x")], "a string, b string")
    a = I.identity(F.col("a"), F.col("b"))
    plan = plan_of(df.select(I.same_medicine(a, a), I.signature(F.col("a"), F.col("b"), F.lit("")), I.relevance(F.col("a"), F.col("b"))))
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_are_pruned_and_filters_pushed(spark):
    plan = plan_of(relational.src1(spark, DATA))
    assert "p_retailprice" not in plan.split("ReadSchema")[1]
    plan = plan_of(views.med(spark, DATA).where("mrp > 1000"))
    assert "GreaterThan(p_retailprice,1000.0)" in plan
