"""Classifiers that are grown together: MLlib's trees, without a job for each of their levels."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from accountwise.config import PRODUCT_FLAGS
from accountwise.operators import boosting, cross_sell
from accountwise.session import cut_lineage, dealt_for_rounds

INPUTS = [f"c{i}" for i in range(8)]


def adopters(spark, n):
    rows = spark.range(n).select(
        F.col("id").alias("account_id"),
        *[(F.xxhash64("id", F.lit(i)) % (7 if i % 3 else 1000)).cast("double").alias(c) for i, c in enumerate(INPUTS)])
    return cut_lineage(rows.select("*", F.lit(3.0).alias("constant"), *[
        (F.col(f"c{k}") + F.col(f"c{k + 3}") * F.col(f"c{k + 4}") / 3 + F.xxhash64("account_id", F.lit(99 + k)) % 5 > 2).cast("int").alias(flag)
        for k, flag in enumerate(PRODUCT_FLAGS.values())]))


def trees(model):
    return model.stages[-1].toDebugString.split("\n", 1)[1]


def jobs(spark, work):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    work()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before


def test_one_block_gives_the_trees_of_mllib(spark):
    rows, inputs = adopters(spark, 900), [*INPUTS, "constant"]
    found = cross_sell.fit_classifiers(rows, inputs, rounds=25)
    vectors = VectorAssembler(inputCols=inputs, outputCol="_inputs").transform(rows)
    for product, flag in PRODUCT_FLAGS.items():
        given = dealt_for_rounds(vectors.withColumn("_weight", F.when(F.col(flag) == 1, 5.0).otherwise(1.0)), "account_id")
        model = GBTClassifier(
            featuresCol="_inputs", labelCol=flag, weightCol="_weight", maxIter=25, maxDepth=5, stepSize=0.05, subsamplingRate=0.8,
            featureSubsetStrategy="0.8", seed=42).fit(given)
        assert trees(found[product]) == model.toDebugString.split("\n", 1)[1]
        assert found[product].stages[-1].treeWeights == model.treeWeights
        assert np.allclose(found[product].stages[-1].featureImportances.toArray(), model.featureImportances.toArray())


def test_rounds_start_no_jobs(spark):
    rows = adopters(spark, 900)
    few, many = (jobs(spark, lambda r=r: cross_sell.fit_classifiers(rows, INPUTS, rounds=r)) for r in (2, 20))
    assert many <= few + 5


def test_blocks_left_in_place_agree(spark, monkeypatch):
    """Many rows: jobs count the blocks where they are. Leaves are large, so that no two splits part the same rows."""
    rows = adopters(spark, 9000)
    at_once = cross_sell.fit_classifiers(rows, INPUTS, rounds=13, depth=2)
    monkeypatch.setattr(boosting, "ROWS_AT_ONCE", 0)
    in_place = cross_sell.fit_classifiers(rows, INPUTS, rounds=13, depth=2)
    mllib = GBTClassifier(
        featuresCol="_inputs", labelCol="y", maxIter=13, maxDepth=2, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8",
        weightCol="w", seed=42)
    flag = next(iter(PRODUCT_FLAGS.values()))
    vectors = VectorAssembler(inputCols=INPUTS, outputCol="_inputs").transform(rows).select(
        "account_id", "_inputs", F.col(flag).alias("y"), F.when(F.col(flag) == 1, 5.0).otherwise(1.0).alias("w"))
    given = mllib.fit(dealt_for_rounds(vectors, "account_id"))
    a, b, c = (m.transform(vectors).orderBy("account_id").toPandas()["probability"].map(lambda v: v[1]) for m in (
        at_once[next(iter(PRODUCT_FLAGS))].stages[-1], in_place[next(iter(PRODUCT_FLAGS))].stages[-1], given))
    assert np.allclose(a, b, atol=1e-9) and np.allclose(a, c, atol=1e-9)


def test_numbers_are_those_of_java(spark):
    """Java's exponential and random numbers, as MLlib draws them."""
    jvm = spark.sparkContext._jvm
    x = np.concatenate([np.linspace(-9, 9, 400), [-800.0, 0.0, 800.0]])
    assert (boosting.java_exp(x) == [jvm.java.lang.Math.exp(float(v)) for v in x]).all()
    drawn = jvm.org.apache.spark.util.random.XORShiftRandom(45)
    assert (boosting.Bag(2, 70, 0.5).uniforms(45) == [drawn.nextDouble() for _ in range(70)]).all()


@pytest.mark.parametrize("labels", [0, 1])
def test_one_class_only(spark, labels):
    rows = adopters(spark, 60).withColumns({flag: F.lit(labels) for flag in PRODUCT_FLAGS.values()})
    models = cross_sell.fit_classifiers(rows, INPUTS, rounds=3)
    scores = cross_sell.probability_matrix(models, rows).agg(*[F.avg(F.col(f"`{p}_score`")).alias(p) for p in PRODUCT_FLAGS]).first()
    assert all(abs(v - labels) < 0.2 for v in scores)
