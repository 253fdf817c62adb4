"""Every query with SQL gives the rows of that SQL."""

import pytest

import __spark_entry__ as entry
from compare import database, difference, spark_table, sql_table

# The corpus operators have tests of their own, in tests/llm.
QUERIES = entry.QUERIES
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con(folder):
    return database(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, folder, con, name):
    assert difference(spark_table(QUERIES[name](spark, folder)), sql_table(con, SQL[name])) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_queries_without_sql_are_the_fitted_ones():
    assert {n for n in QUERIES if n not in SQL} == {
        "fit_logistic", "fit_random_forest", "fit_gbt_weighted", "fit_gbt_leafwise", "fit_gbt_symmetric", "fit_gbt",
        "train_and_select", "feature_importance", "save_load_bundle", "fit_segments", "segment_centers",
        "shap_sampled", "permutation_importance", "score_records_bundle",
    }


def test_entry(spark):
    assert entry.entry(spark).first()["customers"] == 150


@pytest.mark.parametrize(
    "scale, rows, share, blank, young",
    [("sf0.001", 150, 0.26667, 5, 25), ("sf0.01", 1500, 0.28, 19, 165), ("sf0.1", 15000, 0.27913, 188, 1439)],
)
def test_control_values(spark, scale, rows, share, blank, young):
    folder = f"/root/testdata/{scale}"
    kpi = QUERIES["churn_kpis"](spark, folder).first()
    assert (kpi["customers"], kpi["first_year_monthly"]) == (rows, young)
    assert kpi["churned"] / kpi["customers"] == pytest.approx(share, abs=5e-6)
    missing = QUERIES["coerce_numeric"](spark, folder).where("TotalCharges IS NULL").count()
    assert missing == blank
