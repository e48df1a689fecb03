"""The batch jobs one after another, on files written from the smallest data set."""

import pytest
from pyspark.sql import functions as F

from accountwise.plans import binding, jobs
from accountwise.sources.schemas import LOGICAL_NAME

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("jobs"))
    tables = binding.load(spark, SF_DIR)
    for name, logical in LOGICAL_NAME.items():
        if logical in tables:
            df = tables[logical]
            df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.csv(f"{out}/{name}.csv", header=True)
    return out


@pytest.fixture(scope="module")
def matrix(spark, folder):
    path = jobs.build_labels(spark, folder, folder, binding.PARAMS)
    assert spark.read.parquet(path).count() == 150
    return jobs.build_features(spark, folder, f"{folder}/features", binding.PARAMS, "both")[0]


def test_features_match_the_lazy_build(spark, matrix):
    from accountwise.plans.registry import Bound

    lazy = Bound(spark, SF_DIR).features.withColumn("account_id", F.col("account_id").cast("string"))
    # a blank tier is NULL after a CSV load
    lazy = lazy.withColumn("tier", F.nullif("tier", F.lit(""))).drop("feature_timestamp")
    stored = spark.read.parquet(matrix).drop("feature_timestamp").select(lazy.columns)
    assert stored.count() == 150 and stored.exceptAll(lazy).isEmpty()


def test_load_raw_and_marts(spark, folder):
    counts = jobs.load_raw(spark, folder, f"{folder}/wh").collect()  # prediction files do not exist: skipped
    assert len(counts) == 5 and all(r["verified"] and r["rejected"] == 0 for r in counts)
    with pytest.raises(ValueError, match="publish predictions"):
        jobs.build_marts(spark, f"{folder}/wh/raw", f"{folder}/wh", binding.PARAMS.as_of)
    marts = jobs.build_marts(spark, f"{folder}/wh/raw", f"{folder}/wh", binding.PARAMS.as_of, without_predictions=True)
    assert "fact_ml_churn" not in marts and not marts["dim_products"].isEmpty()
    assert marts["mart_clv_analytics"].count() == 150
    plan = marts["fact_bookings"].where("booking_month = date'1998-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(booking_month" in plan


def test_models(spark, folder, matrix):
    out = f"{folder}/models"
    clv = jobs.train_clv(spark, matrix, out, tune=False, rounds=3, depth=3, trees=3)
    assert spark.read.parquet(clv["model_comparison"]).count() == 2
    scores = spark.read.parquet(clv["scores"])
    assert scores.count() == 150 and scores.where("clv_percentile NOT BETWEEN 0 AND 100").isEmpty()
    surv = jobs.train_survival(spark, matrix, out, penalty=0.1)
    churn = spark.read.parquet(surv["churn_predictions"])
    assert churn.count() == 150 and churn.where("churn_risk_score NOT BETWEEN 0 AND 1").isEmpty()
    seg = spark.read.parquet(jobs.segment_accounts(spark, matrix, out, 1.5, 5, 20)["segments"])
    assert seg.count() == 150 and set(seg.columns) == {"account_id", "cluster", "segment", "map_x", "map_y"}
    recs = spark.read.parquet(jobs.train_cross_sell(spark, matrix, out, rounds=2, depth=2)["recommendations"])
    assert recs.count() == 150
    # predictions reach the marts
    jobs.load_raw(spark, folder, f"{folder}/loop")
    jobs.publish_predictions(spark, out, f"{folder}/loop/raw")
    marts = jobs.build_marts(spark, f"{folder}/loop/raw", f"{folder}/loop", binding.PARAMS.as_of)
    assert {"fact_ml_churn", "fact_ml_cross_sell", "dim_products"} <= set(marts)
    assert [name for name, df in marts.items() if df.isEmpty()] == []


def test_checks(spark, folder, matrix):
    checks = jobs.check_tables(spark, folder)
    assert checks.where("check_name = 'null_keys' AND NOT ok").isEmpty()
    assert not checks.where("check_name = 'min_rows' AND NOT ok").isEmpty()
    gate = {r["check_name"]: r["ok"] for r in jobs.check_features(spark, matrix).collect()}
    assert gate == {"min_rows": False, "min_columns": True, "numeric_nulls": True, "target_present": True}


def test_layers_are_stored_at_the_same_time():
    """Layers that need nothing of each other are stored together, each after what it needs."""
    from datetime import date
    from threading import Barrier, Lock
    from unittest import mock

    from accountwise.sources import writers

    done, lock, together = [], Lock(), Barrier(2, timeout=20)
    graph = {
        "a": writers.Layer(("accounts",), lambda t: t), "b": writers.Layer(("accounts",), lambda t: t),
        "c": writers.Layer(("a", "b"), lambda a, b: (a, b)), "d": writers.Layer(("c",), lambda c: c)}

    def store(name, built):
        if name in "ab":
            together.wait()  # breaks unless both are being stored
        with lock:
            done.append(name)
        return name

    tables = dict.fromkeys(("accounts", *writers.PREDICTED), "raw")
    with mock.patch.object(writers, "layer_graph", lambda as_of: graph):
        out = writers.build_layers(tables, date(2024, 1, 1), store=store, at_once=writers.AT_ONCE)
    assert list(out) == list("abcd") and sorted(done[:2]) == ["a", "b"] and done[2:] == ["c", "d"]
