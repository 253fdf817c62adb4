"""Plans stay the ones wanted: pruned scans, no cross joins, no Python in the row path."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
FITTED = {n for n in QUERIES if n not in entry.oracle_sql()} | {"oversample_smote", "balance"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups|FlatMapCoGroups", text)


@pytest.mark.parametrize(
    "name, customer, orders",
    [
        ("churn_by_contract", {"c_custkey", "c_nationkey", "c_mktsegment"}, {"o_custkey", "o_orderstatus"}),
        ("risk_level", {"c_custkey", "c_name", "c_nationkey", "c_mktsegment"}, {"o_custkey"}),
        ("tenure_group", {"c_custkey", "c_name", "c_nationkey"}, {"o_custkey"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, folder, name, customer, orders):
    schemas = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, folder)))]
    assert customer in schemas
    assert all(s <= orders for s in schemas if s != customer)


@pytest.mark.parametrize("name", ["score_batch", "risk_factors", "tenure_bucket", "validate_strict", "one_hot_align"])
def test_row_operators_add_no_shuffle(spark, folder, name):
    """The only exchanges are those of the subscriber join itself."""
    whole = plan(QUERIES["filter_customers"](spark, folder)).count("Exchange ")
    assert plan(QUERIES[name](spark, folder)).count("Exchange ") <= whole


@pytest.mark.parametrize("name", ["churn_kpis", "churn_by_contract", "confusion_matrix", "class_counts", "partial_dependence"])
def test_aggregates_combine_before_the_shuffle(spark, folder, name):
    assert "partial_" in plan(QUERIES[name](spark, folder))
