"""Round trips through files, the stream, and the required shared folder."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

import ebbtide.session as session
from ebbtide.plans.queries import QUERIES
from ebbtide.operators.scoring import score_records
from ebbtide.plans.queries import scratch
from ebbtide.sources import bundle, files
from ebbtide.sources.tables import requests, subscribers
from ebbtide.streaming.score import score_stream


def place(spark):
    return scratch(spark, f"test_{uuid.uuid4().hex}")


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("tenure,customerID,extra\n5,x,1\nbad,y,2\n")
    rows = files.read_customers(spark, str(tmp_path)).orderBy("customerID").collect()
    assert [(r["customerID"], r["tenure"], r["extra"]) for r in rows] == [("x", 5, "1"), ("y", None, "2")]


def test_blank_charges_survive_csv(spark, folder):
    path = place(spark)
    files.write_csv(subscribers(spark, folder), path)
    assert files.read_customers(spark, path).where("TotalCharges = ' '").count() == 5


@pytest.mark.parametrize("text, rows", [('{"customerID": "a", "tenure": 3}', 1), ('[{"tenure": 3}, {"tenure": "4"}]', 2)])
def test_whole_file_requests(spark, tmp_path, text, rows):
    (tmp_path / "r.json").write_text(text)
    got = files.read_requests(spark, str(tmp_path), lines=False).collect()
    assert len(got) == rows and got[0]["tenure"] == "3"


def test_text_that_is_no_list_is_refused(spark, tmp_path):
    (tmp_path / "r.json").write_text('"hello"')
    with pytest.raises(Exception, match="Expected a list of customer data"):
        files.read_requests(spark, str(tmp_path), lines=False).collect()


def test_metrics_defaults(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"accuracy": 0.9}))
    row = files.read_metrics(spark, str(tmp_path)).first()
    assert (row["accuracy"], row["roc_auc"], row["f1_score"], row["precision"], row["recall"]) == (0.9, 0.81, 0.54, 0.57, 0.5)


def test_importance_is_written_in_order(spark):
    path = place(spark)
    files.write_importance(spark.createDataFrame([("a", 0.1), ("c", 0.5), ("b", 0.5)], "Feature string, Importance double"), path)
    assert [r["Feature"] for r in files.read_importance(spark, path).collect()] == ["b", "c", "a"]


def test_thresholds_default_when_none_are_stored(spark):
    assert bundle.load_thresholds(spark, place(spark)) == {"default": 0.5, "f1_threshold": 0.5, "business_threshold": 0.5}


def test_stream_equals_batch_and_resumes(spark, folder):
    root = place(spark)
    sent = requests(spark, folder)
    early, late = sent.where("tenure < '3'"), sent.where("NOT tenure < '3'")
    arguments = (spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint")
    early.write.json(f"{root}/in")
    score_stream(*arguments).awaitTermination()
    first = spark.read.parquet(f"{root}/out").count()
    assert first == early.count()
    late.write.mode("append").json(f"{root}/in")
    score_stream(*arguments).awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert sorted(map(str, out.collect())) == sorted(map(str, score_records(sent).collect()))


def test_scored_records(spark, folder):
    out = score_records(requests(spark, folder))
    assert out.where(F.col("error").isNotNull() & F.col("churn_probability").isNotNull()).count() == 0
    assert out.where(F.col("error").isNull() & ~F.col("churn_probability").between(0, 1)).count() == 0
    assert out.where(F.col("customer_id") == "Unknown").count() > 0


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Elsewhere:
        class sparkContext:
            master, applicationId = "spark://somewhere", "app"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Elsewhere)
    monkeypatch.setattr(Elsewhere.conf, "get", staticmethod(lambda key, default: "hdfs://x/cp/"))
    assert session.shared_folder(Elsewhere) == "hdfs://x/cp/ebbtide/app"


def test_earlier_round_trip_stays_readable(spark, folder):
    first = QUERIES["scan_customers"](spark, folder)
    second = QUERIES["scan_customers"](spark, folder)
    assert second.count() == first.count() > 0
