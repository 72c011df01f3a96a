"""Readers/writers that take configuration rather than table data:
mapping document, run record, failure row, catalogued write."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tessera import sinks as K
from tessera import sources as SR
from tessera.operators import models as MO
from tessera.operators import quality as Q


def test_mapping_document_and_check(spark):
    d = tempfile.mkdtemp(prefix="tessera-map-")
    doc = {"mapping_json_data": {"primary_key": "part_name",
                                 "Inference": {"mappingColumn": "default", "all_algorithms": [],
                                               "mapping": {"a": ["lr", "xgb"], "b": ["rf", "lr"]}},
                                 "Training": {"mappingColumn": "default", "all_algorithms": ["lr", "xgb", "rf"]}}}
    with open(os.path.join(d, "mapping.json"), "w") as f:
        json.dump(doc, f)
    m = SR.read_mapping(spark, d)
    r = m.collect()[0]
    assert r["primary_key"] == "part_name" and sorted(r["inference_algorithms"]) == ["lr", "rf", "xgb"]
    ok = MO.check_mapping(m, ["lr", "rf"], ["lr"]).collect()[0]
    assert ok["valid"] and ok["n_rows"] == 1
    bad = MO.check_mapping(m, ["svm"], ["lr"]).collect()[0]
    assert not bad["valid"]


def test_run_record_round_trip(spark):
    metrics = spark.createDataFrame([("lr", 31), ("mean", 12)], "algoname string, metric_value long")
    win = MO.winner(metrics)
    status = spark.createDataFrame([("Succeeded",), ("Failed",)], "status string")
    rec = MO.run_record(metrics, win, "job-1", "DCP", {"preprocessing": (10, 20), "training": (20, 50)}, status)
    d = tempfile.mkdtemp(prefix="tessera-run-")
    K.write_ndjson(rec.withColumn("year", F.lit("2024")).withColumn("month", F.lit("02"))
                   .withColumn("day", F.lit("01")), d, partition_by=["year", "month", "day"])
    back = SR.read_run_tables(spark, d).collect()[0]
    assert back["winner_algo"] == "lr" and back["training"]["end_time"] == 50
    assert [s["algo_name"] for s in back["algo_scores"]] == ["lr", "mean"]
    assert back["failed_jobs"] == 1


def test_failure_row_and_overall(spark):
    run = {"corelation_id": "wf", "source": "t", "year": "2024", "month": "02", "day": "01"}
    fr = Q.failure_row(spark, run, "evaluation failed").collect()[0]
    assert fr["outcome"] == "Failed" and fr["rule"] == Q.OVERALL_RULE


def test_catalogued_write(spark):
    d = tempfile.mkdtemp(prefix="tessera-cat-")
    df = spark.createDataFrame([(1, "2024", "02", "01")], "x int, year string, month string, day string")
    K.write_catalogued(df, d, "tessera_cat_test")
    K.write_catalogued(df, d, "tessera_cat_test")
    assert spark.table("tessera_cat_test").count() == 1
