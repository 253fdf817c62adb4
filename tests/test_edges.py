"""Hand-made rows at the edges of every rule."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import bands, features
from ebbtide.operators import cleaning, cohort, reports, scoring, segments, validation
from ebbtide.schema import CUSTOMER

GOOD = dict(
    customerID="a", gender="Male", SeniorCitizen=0, Partner="No", Dependents="No", tenure=10, PhoneService="Yes",
    MultipleLines="No", InternetService="DSL", OnlineSecurity="No", OnlineBackup="No", DeviceProtection="No",
    TechSupport="No", StreamingTV="No", StreamingMovies="No", Contract="One year", PaperlessBilling="No",
    PaymentMethod="Mailed check", MonthlyCharges=50.0, TotalCharges="500", Churn="No",
)


def customers(spark, *changes, schema=CUSTOMER):
    return spark.createDataFrame([{**GOOD, **c} for c in changes], schema)


def column(df, name):
    return [row[name] for row in df.collect()]


@pytest.mark.parametrize(
    "sql, want",
    [
        (features.TENURE_BUCKET, [None, "0-6mo", "6-12mo", "6-12mo", "1-2yr", "1-2yr", "2-3yr", "3-5yr", "5yr+", "5yr+", "5yr+"]),
        (features.TENURE_GROUP, [None, "0-12", "0-12", "0-12", "13-24", "13-24", "25-36", "37-60", "61-72", "61-72", None]),
    ],
)
def test_tenure_intervals(spark, sql, want):
    tenures = [0, 6, 7, 12, 13, 24, 36, 60, 61, 72, 73]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tenures)], "i int, tenure int").orderBy("i")
    assert column(df.select(F.expr(sql).alias("v")), "v") == want
    assert spark.sql("SELECT CAST('NaN' AS DOUBLE) AS tenure").select(F.expr(sql).alias("v")).first()["v"] is None


def test_number_parsing(spark):
    texts = [" ", "", "abc", "NaN", "1.0d", "2f", "12.5", " 7 ", "1e3", None, "-4"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, TotalCharges string").orderBy("i")
    want = [None, None, None, None, None, None, 12.5, 7.0, 1000.0, None, -4.0]
    assert column(df.select(bands.number("TotalCharges").alias("v")), "v") == want


def test_clean_drops_before_recoding(spark):
    df = customers(spark, {"TotalCharges": " "}, {"Churn": None}, {"Churn": "Maybe"}, {"SeniorCitizen": 7, "Churn": "Yes"})
    rows = cleaning.clean_customers(df).collect()
    assert [(r["SeniorCitizen"], r["Churn"]) for r in rows] == [("No", None), (None, 1)]


def test_target_to_label_keeps_text(spark):
    df = customers(spark, {"Churn": "Yes"})
    assert cleaning.target_to_label(df) is df
    numeric = cleaning.recode_target(df)
    assert column(cleaning.target_to_label(numeric), "Churn") == ["Yes"]


def test_features_on_missing_values(spark):
    df = cleaning.coerce_numeric(customers(spark, {"InternetService": None, "PhoneService": None, "OnlineSecurity": None}))
    row = cleaning.create_features(df).first()
    assert row["HasInternetService"] is True and row["HasPhoneService"] is False
    assert row["NoSecurity"] == 0 and row["ServiceCount"] == 0
    assert row["AvgMonthlySpend"] == 500 / 11


def test_create_features_variants(spark):
    df = cleaning.coerce_numeric(customers(spark, {}))
    assert "ServiceCount" not in cleaning.create_features(df.withColumn("InternetService_No", F.lit(0))).columns
    assert "Senior_HighCharge" not in cleaning.create_features(df.drop("SeniorCitizen")).columns


def test_senior_high_charge_is_strict_and_reads_both_codes(spark):
    rows = [{"SeniorCitizen": 1, "MonthlyCharges": m} for m in (10.0, 20.0, 30.0)]
    raw = cleaning.coerce_numeric(customers(spark, *rows))
    for df in (raw, cleaning.recode_senior(raw)):
        out = cleaning.create_features(df).orderBy("MonthlyCharges")
        assert column(out, "Senior_HighCharge") == [0, 0, 1]


def test_align_fills_unknown_columns(spark):
    df = spark.createDataFrame([("a", 3, "Two year", True)], "customerID string, tenure int, Contract string, IsMonthToMonth boolean")
    row = cleaning.one_hot_align(df, ("tenure", "Contract_Two year", "Contract_One year", "gender_Male", "IsMonthToMonth")).first()
    assert tuple(row)[1:] == (3, 1, 0, 0, True)
    with pytest.raises(ValueError, match="No matching columns"):
        cleaning.one_hot_align(df.select("customerID"), ("tenure",))


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    scaler = cleaning.fit_scaler(df, ("a", "b"))
    assert scaler == {"a": (5.0, 1.0), "b": (2.0, 1.0)}
    assert sorted(map(tuple, cleaning.standard_scale(df, scaler).collect())) == [(0.0, -1.0), (0.0, 1.0)]


@pytest.mark.parametrize("p, level", [(0.0, "Low"), (0.3, "Low"), (0.300001, "Medium"), (0.7, "Medium"), (0.71, "High"), (1.0, "High"), (None, None)])
def test_risk_level(spark, p, level):
    df = spark.createDataFrame([(p,)], "p double")
    assert df.select(bands.risk_level("p").alias("v")).first()["v"] == level


def test_threshold_modes():
    stored = {"f1_threshold": 0.4, "business_threshold": 0.2, "default": 0.9}
    assert [scoring.choose_threshold(stored, m) for m in ("default", "f1", "business", "x")] == [0.5, 0.4, 0.2, 0.5]
    assert scoring.choose_threshold({}, "f1") == 0.5


def test_risk_factors_in_order_and_empty(spark):
    df = customers(spark, {"Contract": "Month-to-month", "InternetService": "Fiber optic", "PaymentMethod": "Electronic check", "tenure": 1},
                   {"InternetService": "No", "tenure": 12, "TechSupport": "No"})
    found = column(df.select(bands.risk_factors().alias("v")), "v")
    assert [len(f) for f in found] == [6, 0]
    assert found[0][0] == "Month-to-month contract" and found[0][-1] == "No technical support"


def test_empty_list_switches_filter_off(spark):
    df = customers(spark, {}, {"Contract": "Two year"})
    assert validation.filter_customers(df, [], ["DSL"]).count() == 2
    assert validation.filter_customers(df, ["Two year"], ["DSL"]).count() == 1
    assert tuple(validation.filter_counts(df, ["Two year"], ["DSL"]).first()) == (1, 2)
    assert tuple(validation.filter_counts(df, [], []).first()) == (2, 2)


@pytest.mark.parametrize(
    "change, message",
    [
        ({}, None),
        ({"tenure": -1}, "Tenure must be a non-negative number"),
        ({"MonthlyCharges": 0.0}, "MonthlyCharges must be a positive number"),
        ({"MonthlyCharges": float("nan")}, "MonthlyCharges must be a positive number"),
        ({"Contract": "Weekly"}, "Contract must be 'Month-to-month', 'One year', or 'Two year'"),
        ({"InternetService": "Cable"}, "InternetService must be 'DSL', 'Fiber optic', or 'No'"),
        ({"PaymentMethod": "Barter"}, None),
        ({"Contract": None, "tenure": None}, "Missing required fields: tenure, Contract"),
    ],
)
def test_strict_rules(spark, change, message):
    assert validation.validate_strict(customers(spark, change)).first()["error"] == message


def test_lenient_rules(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("customerID", "tenure", "MonthlyCharges", "Contract")])
    rows = [("a", "-5", "1", "x"), ("b", "abc", "1", "x"), ("c", "1", "NaN", "x"), (None, "1", "2", None)]
    out = validation.split_valid(spark.createDataFrame(rows, schema))
    got = {r["customer_id"]: r["error"] for r in out.collect()}
    assert got == {
        "a": None, "b": "Tenure must be a number", "c": "MonthlyCharges must be a number",
        "Unknown": "Missing required fields: Contract",
    }


def test_frame_verdicts(spark):
    good = customers(spark, {}, {})
    assert validation.check_frame(good) == (True, "Data is valid")
    assert validation.check_frame(good.limit(0)) == (True, "Data is valid")
    bad = customers(spark, {}, {"InternetService": "Cable"}, {"MonthlyCharges": -1.0})
    assert validation.check_frame(bad, raise_exception=False) == (False, "MonthlyCharges must be a positive number")
    missing = good.drop("tenure", "PaymentMethod")
    assert validation.check_frame(missing, raise_exception=False)[1] == "Missing required fields: tenure, PaymentMethod"
    with pytest.raises(ValueError, match="Missing required"):
        validation.check_frame(missing)
    assert column(validation.validate_strict(missing), "error") == ["Missing required fields: tenure, PaymentMethod"] * 2


def test_reports_on_an_empty_table(spark):
    empty = customers(spark, {}).limit(0)
    kpi = reports.churn_kpis(empty).first()
    assert (kpi["customers"], kpi["churn_rate"], kpi["monthly_revenue"]) == (0, None, 0.0)
    assert reports.churn_rate_by(empty, "Contract").count() == 0
    assert [r["tenure"] for r in reports.correlation_matrix(empty).collect()] == [None] * 3


def test_crosstab_leaves_out_missing_keys_and_classes(spark):
    df = customers(spark, {"Churn": "Yes"}, {"Churn": None}, {"Contract": None, "Churn": "Yes"}, {})
    assert [tuple(r) for r in reports.crosstab_rate(df, "Contract").collect()] == [("One year", 2, 50.0, 50.0)]


def test_lifetime_of_a_group_without_churn(spark):
    row = reports.lifetime_value(customers(spark, {}, {"Churn": None})).first()
    assert (row["churn_rate"], row["lifetime_months"], row["lifetime_value"]) == (0.0, 60.0, 3000.0)


def test_similar_customers_without_history(spark):
    probes = customers(spark, {"Contract": "Two year", "tenure": 40})
    row = cohort.similar_customers(probes.withColumn("p", F.lit(0.0)), customers(spark, {})).first()
    assert (row["similar_customers"], row["cohort_churn_rate"]) == (0, 0.0)
    assert cohort.cohort_risk_compare(spark.createDataFrame([(0.2, 0.2)], "p double, cohort_churn_rate double")).first()["risk_vs_cohort"] == "lower than average"


def test_similar_customers_range_is_inclusive(spark):
    history = customers(spark, *[{"tenure": t, "Churn": "Yes" if t == 24 else "No"} for t in (0, 11, 12, 24, 36, 37)])
    row = cohort.similar_customers(customers(spark, {"tenure": 24}), history).first()
    assert (row["similar_customers"], row["cohort_churn_rate"]) == (3, 1 / 3)


def test_half_even_rounding_of_segments(spark):
    rows = [(0, 0.0625, 1), (0, 0.0625, 0)]
    df = spark.createDataFrame([(c, 0.25, 0.35, v, y) for c, v, y in rows], "Cluster int, tenure double, MonthlyCharges double, TotalCharges double, Churn int")
    row = segments.segment_profile(df).first()
    assert (row["ChurnRate"], row["tenure"], row["TotalCharges"], row["Percentage"]) == (0.5, 0.2, 0.1, 100.0)


def test_nearest_prefers_the_lower_number(spark):
    df = spark.createDataFrame([(5.0, 0.0, 0.0)], "tenure double, MonthlyCharges double, TotalCharges double")
    assert segments.assign_segments(df, {0: (0.0, 0.0, 0.0), 1: (10.0, 0.0, 0.0)}).first()["Cluster"] == 0
