"""Attributions against Shapley's definition on small trees, and their sums against the model."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from accountwise.operators import attribution


def value(own, weight, x, known):
    def below(at):
        prediction, rows, left, right, column, threshold = own[at]
        if left < 0:
            return prediction
        if column in known:
            return below(left if x[column] <= threshold else right)
        return sum(own[c][1] / rows * below(c) for c in (left, right))

    return weight * below(0)


def shapley(nodes, weights, x):
    by_tree = {}
    for tree, at, *rest in nodes:
        by_tree.setdefault(tree, {})[at] = tuple(rest)
    v = lambda s: sum(value(own, weights[t], x, s) for t, own in by_tree.items())
    n, out = len(x), []
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        out.append(sum(
            factorial(k) * factorial(n - k - 1) / factorial(n) * (v({*s, i}) - v(set(s))) for k in range(n) for s in combinations(rest, k)))
    return v(set()), out


@pytest.mark.parametrize("learner", [
    lambda: GBTRegressor(maxIter=4, maxDepth=4, stepSize=0.3, seed=1), lambda: RandomForestRegressor(numTrees=3, maxDepth=4, seed=1)])
def test_shapley_values(spark, learner):
    learner = learner()
    rng = np.random.default_rng(2)
    rows = [(k, *map(float, rng.integers(0, 6, 4))) for k in range(150)]
    inputs = ["a", "b", "c", "d"]
    frame = spark.createDataFrame(rows, "account_id long, a double, b double, c double, d double")
    frame = frame.withColumn("y", F.expr("a * b + c - (case when a > 2 then d * d else 0 end)"))
    learner = learner.setFeaturesCol("_inputs").setLabelCol("y")
    model = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="_inputs"), learner]).fit(frame)
    nodes, weights = attribution.tree_nodes(spark, model), list(model.stages[-1].treeWeights)
    if isinstance(learner, RandomForestRegressor):
        weights = [1 / 3] * 3
    got = {r["account_id"]: r for r in attribution.row_attributions(model, frame, inputs).collect()}
    predicted = {r["account_id"]: r["prediction"] for r in model.transform(frame).collect()}
    assert len(got) == 150
    for row in rows:
        assert got[row[0]]["prediction"] == pytest.approx(predicted[row[0]])
    for row in rows[:12]:
        expected, want = shapley(nodes, weights, row[1:])
        assert got[row[0]]["expected"] == pytest.approx(expected)
        assert list(got[row[0]]["contributions"]) == pytest.approx(want, abs=1e-9)
    some = attribution.row_attributions(model, frame, inputs, rows=20)
    assert some.count() == 20 and attribution.long_attributions(some, inputs).count() == 80
    assert attribution.attribution_importance(some, inputs).count() == 4
    assert attribution.row_attributions(model, frame.where("false"), inputs).count() == 0


def test_tasks_follow_the_rows(spark):
    """Every task makes the tables of all leaves, so few rows in many partitions are few tasks."""
    frame = spark.range(0, 900, 1, 40).select(F.col("id").alias("account_id"), (F.col("id") % 7).cast("double").alias("a"))
    frame = frame.withColumn("y", F.col("a") * F.col("a"))
    learner = GBTRegressor(featuresCol="_inputs", labelCol="y", maxIter=2, maxDepth=2, seed=1)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="_inputs"), learner]).fit(frame)
    got = attribution.row_attributions(model, frame, ["a"])
    assert got.rdd.getNumPartitions() == 1 and got.count() == 900
