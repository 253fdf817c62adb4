"""Request bodies: types as sent, lists and objects, bodies that are neither."""

import json

import pytest

from ebbtide.operators import payloads
from ebbtide.sources import files

GOOD = {"customerID": "a", "tenure": 12, "MonthlyCharges": 70.5, "InternetService": "DSL", "Contract": "One year", "PaymentMethod": "Mailed check"}
TENURE = "Tenure must be a non-negative number"


def frame(spark, *bodies):
    return spark.createDataFrame([(i, b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "n int, payload string")


def errors(spark, *bodies, strict=True):
    return [r["error"] for r in payloads.checked_payloads(frame(spark, *bodies).coalesce(1), strict).collect()]


@pytest.mark.parametrize("tenure, strict, lenient", [
    (12, None, None),
    (0, None, None),
    (1.5, None, None),
    (1e3, None, None),
    (True, None, "Tenure must be a number"),
    ("12", TENURE, None),
    ("x", TENURE, "Tenure must be a number"),
    (-1, TENURE, None),
    (None, TENURE, "Tenure must be a number"),
    ([12], TENURE, "Tenure must be a number"),
])
def test_numbers_keep_the_type_they_were_sent_in(spark, tenure, strict, lenient):
    body = {**GOOD, "tenure": tenure}
    assert errors(spark, body) == [strict]
    assert errors(spark, body, strict=False) == [lenient]


def test_fields_not_sent_differ_from_null(spark):
    without = {k: v for k, v in GOOD.items() if k not in ("tenure", "Contract")}
    assert errors(spark, without, {**GOOD, "Contract": None}) == [
        "Missing required fields: tenure, Contract",
        "Contract must be 'Month-to-month', 'One year', or 'Two year'",
    ]


def test_a_list_gives_the_rows_of_its_objects(spark):
    other = {**GOOD, "customerID": "b", "tenure": "3"}
    rows = lambda *b: [tuple(r) for r in payloads.checked_payloads(frame(spark, *b).coalesce(1)).collect()]
    assert rows([GOOD, other]) == rows(GOOD, other)
    assert rows([]) == []
    assert rows([GOOD, GOOD]) == 2 * rows(GOOD)


@pytest.mark.parametrize("body", ["no json", "", None, "5", "null", '"text"', '{"a":1, "a":2}', "{"])
def test_neither_list_nor_object(spark, body):
    (row,) = payloads.checked_payloads(frame(spark, body)).collect()
    assert row["customer_id"] == "Unknown"
    assert row["error"] in (payloads.NOT_RECORDS, "Missing required fields: tenure, MonthlyCharges, InternetService, Contract, PaymentMethod")


def test_elements_that_are_no_object(spark):
    assert errors(spark, [GOOD, 3, None, "x"]) == [None] + 3 * [payloads.NOT_RECORDS]


def test_other_columns_stay_and_may_clash(spark):
    given = frame(spark, [GOOD, GOOD]).withColumnsRenamed({"n": "tenure"})
    got = payloads.payload_records(given)
    assert got.columns == ["tenure", "position", "record"] and [r["position"] for r in got.collect()] == [0, 1]
    assert [r["error"] for r in payloads.checked_payloads(given).collect()] == [None, None]


def test_only_valid_records_have_scores(spark):
    body = [GOOD, {**GOOD, "tenure": "abc"}, {**GOOD, "tenure": "30"}]
    got = payloads.score_payloads(frame(spark, body)).collect()
    assert [r["error"] for r in got] == [None, "Tenure must be a number", None]
    assert all(0 < got[i]["churn_probability"] < 1 for i in (0, 2)) and got[1]["churn_probability"] is None


def test_empty_table_and_whole_files(spark, tmp_path):
    assert payloads.checked_payloads(frame(spark, GOOD).limit(0)).count() == 0
    (tmp_path / "one.json").write_text(json.dumps([GOOD, GOOD], indent=2))
    (tmp_path / "two.json").write_text("broken\ntext")
    got = payloads.checked_payloads(files.read_payloads(spark, str(tmp_path), lines=False)).collect()
    assert sorted(str(r["error"]) for r in got) == [payloads.NOT_RECORDS, "None", "None"]
