"""Plan hygiene over every registered query: JVM-only expressions, no cross
or nested-loop joins, no row caps except where the limit is the feature."""

import pytest

from conftest import SF_SMALL
from strata.plans.queries import QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin", "Sample")
LIMITS = ("GlobalLimit", "CollectLimit", "TakeOrderedAndProject", "LocalLimit")
LIMIT_IS_THE_FEATURE = {"top_customers", "rewritten_preview"}


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in QUERIES.items():
        df = fn(spark, SF_SMALL)
        out[name] = df._jdf.queryExecution().executedPlan().toString()
    return out


def test_every_query_stays_in_the_jvm_and_has_no_cross_join(plans):
    bad = {n: [f for f in FORBIDDEN if f in p] for n, p in plans.items()}
    assert {n: f for n, f in bad.items() if f} == {}


def test_limits_only_where_they_are_the_feature(plans):
    limited = {n for n, p in plans.items() if any(x in p for x in LIMITS)}
    assert limited == LIMIT_IS_THE_FEATURE


def test_scans_are_column_pruned(spark):
    df = QUERIES["mart_sales_by_category"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line)
    schema = scan[scan.index("ReadSchema: struct<"):]
    # lineitem has 11 columns; the mart reads the 5 it uses
    assert schema.count(":") - 1 == 5 and "l_discount" not in schema and "l_shipdate" not in schema
