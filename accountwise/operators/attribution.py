"""What each input adds to one account's prediction: Shapley values over fitted trees, by the paths of their leaves.

The value of a set of inputs is the prediction when a split on an input of the set follows the account and any other split
follows both sides, in the shares of the training rows that went there. A leaf's part in that depends only on which of the
inputs on its path agree with the account. A path has few inputs, so each leaf has a small table, one line for each pattern of
agreement, with the Shapley value of each of its inputs; the tables are made once in a task, and an account looks its pattern up.
The values of an account and the ensemble's expectation add up to its prediction.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.session import run_dir, tasks_for

#: Accounts whose values a task holds at once, and leaves whose tables it makes at once.
ROWS, LEAVES = 4096, 1024


@dataclass
class Leaf:
    """inputs: the distinct ones on the path; low < x <= high agrees; share: of the training rows, by input."""

    tree: int
    inputs: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: float


def tables(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The values of leaves with d inputs each: (leaves, d, patterns of agreement), where bit k of a pattern is input k."""
    n, d = share.shape
    out = np.zeros((n, d, 1 << d))
    weight = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
    agrees = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
    for i in range(d):
        # coefficients by size of the set, of the products over all other inputs
        sets = np.zeros((n, 1 << d, d))
        sets[:, :, 0] = 1.0
        for j in range(d):
            if j != i:
                more = sets * share[:, j, None, None]
                more[:, :, 1:] += sets[:, :, :-1] * agrees[:, j, None]
                sets = more
        out[:, i] = value[:, None] * (agrees[:, i] - share[:, i, None]) * (sets @ weight)
    return out


@dataclass
class Tree:
    """What a task keeps of a tree: the distinct intervals of its leaves, and for the leaves of as many inputs their intervals' places
    (leaves, d), their inputs and their tables."""

    inputs: np.ndarray
    low: np.ndarray
    high: np.ndarray
    groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def add(self, x: np.ndarray, out: np.ndarray) -> None:
        """Adds the values of the accounts in x; both are (inputs, accounts)."""
        own = x[self.inputs]
        agrees = ((own > self.low[:, None]) & (own <= self.high[:, None])).astype(np.uint16)
        for places, inputs, table in self.groups:
            pattern = agrees[places[:, 0]]
            for k in range(1, places.shape[1]):
                pattern |= agrees[places[:, k]] << k
            for own_pattern, columns, values in zip(pattern.astype(np.intp), inputs, table):
                for column, of_pattern in zip(columns, values):
                    out[column] += of_pattern.take(own_pattern)


def grown(found: Sequence[Leaf]) -> list[Tree]:
    """The trees of leaves, with their tables."""
    by_size: dict[int, list[int]] = {}
    for at, leaf in enumerate(found):
        by_size.setdefault(len(leaf.inputs), []).append(at)
    table: dict[int, np.ndarray] = {}
    for d, members in by_size.items():
        step = max(1, (LEAVES << 6) >> d)
        for start in range(0, len(members), step):
            part = members[start : start + step]
            made = tables(np.array([found[at].share for at in part]), np.array([found[at].value for at in part]))
            table |= dict(zip(part, made))
    by_tree: dict[int, list[int]] = {}
    for at, leaf in enumerate(found):
        by_tree.setdefault(leaf.tree, []).append(at)
    out = []
    for members in by_tree.values():
        place: dict[tuple, int] = {}
        groups: dict[int, list[tuple]] = {}
        for at in members:
            leaf = found[at]
            places = [place.setdefault(key, len(place)) for key in zip(leaf.inputs, leaf.low, leaf.high)]
            groups.setdefault(len(places), []).append((places, leaf.inputs, table[at]))
        inputs, low, high = zip(*place)
        out.append(Tree(np.array(inputs), np.array(low), np.array(high), [tuple(map(np.array, zip(*g))) for g in groups.values()]))
    return out


def leaves(nodes: Sequence[tuple], weights: Sequence[float]) -> tuple[list[Leaf], float]:
    """The leaves of all trees and the expectation; nodes: (tree, id, prediction, rows, left, right, input, threshold)."""
    by_tree: dict[int, dict[int, tuple]] = {}
    for tree, at, *rest in nodes:
        by_tree.setdefault(tree, {})[at] = tuple(rest)
    out, expected = [], 0.0
    for tree, own in by_tree.items():
        todo = [(0, {}, 1.0)]
        while todo:
            at, path, share = todo.pop()
            prediction, rows, left, right, column, threshold = own[at]
            if left < 0:
                value = weights[tree] * prediction
                expected += share * value
                if path:
                    names = sorted(path)
                    low, high, parts = zip(*(path[c] for c in names))
                    out.append(Leaf(tree, np.array(names), np.array(low), np.array(high), np.array(parts), value))
                continue
            for child, is_left in ((left, True), (right, False)):
                part = own[child][1] / rows
                low, high, before = path.get(column, (-np.inf, np.inf, 1.0))
                bounds = (low, min(high, threshold)) if is_left else (max(low, threshold), high)
                todo.append((child, path | {column: (*bounds, before * part)}, share * part))
    return out, expected


def tree_nodes(spark: SparkSession, model: PipelineModel) -> list[tuple]:
    """The nodes of a fitted ensemble, from its stored form; as many as the trees have, whatever the accounts."""
    path = run_dir(spark, "trees")
    model.stages[-1].write().save(path)
    n = "nodeData"
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", f"{n}.id", f"{n}.prediction", f"{n}.rawCount", f"{n}.leftChild", f"{n}.rightChild", f"{n}.split.featureIndex",
        F.get(f"{n}.split.leftCategoriesOrThreshold", F.lit(0)), f"{n}.split.numCategories")
    out = []
    for *node, categories in rows.collect():
        if node[4] >= 0 and categories != -1:
            raise ValueError("attribution takes numeric inputs only")
        out.append(tuple(node))
    return out


def row_attributions(model: PipelineModel, frame: DataFrame, inputs: Sequence[str], rows: int | None = None) -> DataFrame:
    """account_id, prediction, expected, and contributions: one number for each input.

    ``rows`` takes a sample of so many accounts, those with the smallest hashes of their ids; None takes all.
    """
    spark = frame.sparkSession
    chosen = frame.select("account_id", *[F.col(c).cast("double").alias(c) for c in inputs])
    if rows is not None:
        chosen = chosen.orderBy(F.xxhash64("account_id"), "account_id").limit(rows)
    chosen = chosen.coalesce(tasks_for(frame.count() if rows is None else rows, spark))  # each task makes all tables
    fitted = model.stages[-1]
    weights = list(fitted.treeWeights)
    if isinstance(fitted, RandomForestRegressionModel):  # predicts the mean of its trees
        weights = [w / sum(weights) for w in weights]
    found, expected = leaves(tree_nodes(spark, model), weights)
    shared, names = spark.sparkContext.broadcast(found), list(inputs)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = grown(shared.value)
        for batch in frames:
            for start in range(0, len(batch), ROWS):
                part = batch.iloc[start : start + ROWS]
                x = np.ascontiguousarray(part[names].to_numpy(float).T)
                out = np.zeros_like(x)
                for tree in trees:
                    tree.add(x, out)
                yield pd.DataFrame({
                    "account_id": part["account_id"].to_numpy(), "prediction": expected + out.sum(0), "expected": expected,
                    "contributions": list(out.T)})

    kind = frame.schema["account_id"].dataType.simpleString()
    return chosen.mapInPandas(run, f"account_id {kind}, prediction double, expected double, contributions array<double>")


def long_attributions(attributions: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """One row for each account and input."""
    names = F.array(*[F.lit(c) for c in inputs])
    cells = F.explode(F.arrays_zip(names.alias("feature"), F.col("contributions").alias("contribution")))
    return attributions.select("account_id", cells.alias("x")).select("account_id", "x.feature", "x.contribution")


def attribution_importance(attributions: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Mean size of each input's contributions."""
    return long_attributions(attributions, inputs).groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
