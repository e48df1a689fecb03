"""Customer-value regression: split, boosted trees, metrics, importance, percentile scoring."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.functions.columns import rate
from accountwise.operators.ranking import exact_quantiles, running_totals
from accountwise.session import dealt_for_rounds

HASH_BITS = 32


def hash_split(df: DataFrame, key: str, parts: dict[str, float], salt: str = "", by: str | None = None) -> DataFrame:
    """Repeatable split by a hash of the key, of exact size within every value of ``by``.

    The rank of the hash decides, so each stratum is cut at the same shares. A hash is uniform, hence
    the value ranges of the running total are known without looking at the data, and a stratum that
    holds most rows is still spread over all of them.
    """
    digest = F.md5(F.concat_ws(":", F.lit(salt), F.col(key).cast("string")))
    hashed = df.withColumn("_h", F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint"))
    n = max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = [2.0**HASH_BITS * i / n for i in range(1, n)]
    strata = [by] if by else []
    counted = hashed.groupBy(*strata, "_h").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(counted, strata, "_h", ["_n"], cuts)
    share = (F.col("cum__n") - F.col("_n")) / F.col("total__n")
    label, upto = None, 0.0
    for name, part in parts.items():
        upto += part
        inside = share < F.lit(round(upto, 9))
        label = F.when(inside, name) if label is None else label.when(inside, name)
    assigned = ranked.select(
        *[F.col(c).alias(f"_of_{c}") for c in (*strata, "_h")], label.otherwise(name).alias("split")
    )
    match = F.col("_h") == F.col("_of__h")
    for c in strata:
        match = match & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return hashed.join(assigned, match, "inner").select(*df.columns, "split")


def training_frame(features: DataFrame, inputs: Sequence[str], target: str = "clv_12m") -> DataFrame:
    """Inputs, log target and a 70/15/15 split cut within every tier."""
    frame = features.select(
        "account_id", "tier", *inputs, F.col(target), F.log1p(F.col(target)).alias("log_target")
    )
    return hash_split(frame, "account_id", {"train": 0.70, "validation": 0.15, "test": 0.15}, "clv", by="tier")


def split_sizes(frame: DataFrame) -> DataFrame:
    return frame.groupBy("tier", "split").agg(
        F.count(F.lit(1)).alias("accounts"), F.sum("log_target").alias("sum_log_target")
    )


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The fitted model's first n trees as a model: what n rounds with the same seed would have given."""
    spark, fitted = SparkSession.getActiveSession(), model._java_obj
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    for k, (tree, weight) in enumerate(zip(list(fitted.trees())[:n], list(fitted.treeWeights())[:n])):
        trees[k], weights[k] = tree, weight
    cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(fitted.uid(), trees, weights, fitted.numFeatures())
    return GBTRegressionModel._from_java(fitted.copyValues(cut, fitted.extractParamMap()))


def _halves(frame: DataFrame, inputs: Sequence[str]) -> tuple[VectorAssembler, DataFrame, DataFrame]:
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="_inputs")
    train, held = (
        dealt_for_rounds(assembler.transform(frame.where(F.col("split") == part)).select("account_id", "_inputs", "log_target"), "account_id")
        for part in ("train", "validation")
    )
    return assembler, train, held


def _boosted(train: DataFrame, held: DataFrame, rounds: int, seed: int, setting: dict) -> tuple[GBTRegressionModel, np.ndarray]:
    """One fit, and its squared error on the held-out rows after every round."""
    given = {"subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"} | setting
    model = GBTRegressor(featuresCol="_inputs", labelCol="log_target", maxIter=rounds, seed=seed, **given).fit(train)
    return model, np.array(model.evaluateEachIteration(held, "squared"))


def fit_boosted(
    frame: DataFrame, inputs: Sequence[str], rounds: int = 500, depth: int = 6, step: float = 0.05,
    setting: dict | None = None, patience: int = 50, seed: int = 42,
) -> PipelineModel:
    """Boosted trees, as many as are best on the validation split: a fit is evaluated after every round and cut to the best.

    The first fit has 2 * ``patience`` rounds. Only if its best one lies in the last ``patience`` is it followed by one of all
    ``rounds``. With nothing held out all rounds are kept. ``setting`` overrides the learner's parameters, for instance
    with those of ``search_boosted``.
    """
    assembler, train, held = _halves(frame, inputs)
    n = min(rounds, 2 * patience)
    while True:
        model, errors = _boosted(train, held, n, seed, {"maxDepth": depth, "stepSize": step} | (setting or {}))
        best = n if np.isnan(errors).any() else int(errors.argmin()) + 1
        if n == rounds or best + patience <= n:
            return PipelineModel([assembler, model if best == n else first_trees(model, best)])
        n = rounds


def drawn_settings(points: int, seed: int) -> list[dict]:
    """Settings drawn at random: depth, step (log-uniform), shares of rows and inputs, least rows of a leaf, least gain (log-uniform)."""
    rng = np.random.default_rng(seed)
    return [
        {
            "maxDepth": int(rng.integers(3, 11)), "stepSize": float(np.exp(rng.uniform(np.log(0.01), np.log(0.3)))),
            "subsamplingRate": float(rng.uniform(0.6, 1.0)), "featureSubsetStrategy": f"{rng.uniform(0.5, 1.0):.6f}",
            "minInstancesPerNode": int(rng.integers(1, 11)), "minInfoGain": float(np.exp(rng.uniform(np.log(1e-8), np.log(1e-1)))),
        }
        for _ in range(points)
    ]


def search_boosted(
    frame: DataFrame, inputs: Sequence[str], points: int = 50, first: int = 8, rounds: int = 500, keep: float = 1 / 3,
    parallelism: int = 4, seed: int = 42,
) -> list[dict]:
    """Successive halving: all drawn settings are fitted with few rounds, the best third of them with three times as many, and
    so on up to ``rounds`` or one setting. A trial's error is the least after any of its rounds, on the validation split.

    Returns every trial: rung, setting (its number), its parameters, rounds, best_round, rmse, kept. Ties keep the
    smaller number. The fits are Spark jobs, ``parallelism`` of them at a time.
    """
    _, train, held = _halves(frame, inputs)
    settings, alive, trials, rung, n = drawn_settings(points, seed), list(range(points)), [], 0, min(first, rounds)
    with ThreadPool(max(1, min(parallelism, points))) as pool:
        while alive:
            def tried(k: int) -> dict:
                errors = _boosted(train, held, n, seed, settings[k])[1]
                best = n if np.isnan(errors).any() else int(errors.argmin()) + 1
                return {
                    "rung": rung, "setting": k, **settings[k], "rounds": n, "best_round": best, "rmse": float(np.sqrt(errors[best - 1])),
                }

            results = sorted(pool.map(tried, alive), key=lambda t: (t["rmse"], t["setting"]))
            last = len(alive) == 1 or n == rounds
            stay = 1 if last else max(1, int(len(alive) * keep))
            trials += [t | {"kept": k < stay} for k, t in enumerate(results)]
            alive = [] if last else sorted(t["setting"] for t in results[:stay])
            rung, n = rung + 1, min(rounds, round(n / keep))
    return trials


def best_setting(trials: Sequence[dict]) -> dict:
    """The learner's parameters of the trial that the search kept last."""
    winner = [t for t in trials if t["kept"]][-1]
    return {k: winner[k] for k in drawn_settings(1, 0)[0]}


TRIAL = (
    "rung int, setting int, maxDepth int, stepSize double, subsamplingRate double, featureSubsetStrategy string, "
    "minInstancesPerNode int, minInfoGain double, rounds int, best_round int, rmse double, kept boolean"
)


def trial_table(spark: SparkSession, trials: Sequence[dict]) -> DataFrame:
    names = [c.split()[0] for c in TRIAL.split(", ")]
    return spark.createDataFrame([tuple(t[n] for n in names) for t in trials], TRIAL)


def fit_forest(
    frame: DataFrame, inputs: Sequence[str], trees: int = 100, depth: int = 6, seed: int = 42
) -> PipelineModel:
    """The benchmark learner."""
    learner = RandomForestRegressor(
        featuresCol="_inputs", labelCol="log_target", numTrees=trees, maxDepth=depth, seed=seed
    )
    assembler, train, _ = _halves(frame, inputs)
    return PipelineModel([assembler, learner.fit(train)])


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Adds ``predicted_clv`` in money, floored at 0."""
    money = F.greatest(F.lit(0.0), F.expm1("prediction"))
    return model.transform(features).withColumn("predicted_clv", money).drop("_inputs", "prediction")


def regression_metrics(predictions: DataFrame, keys: Sequence[str] = ("model",), cuts=None) -> DataFrame:
    """MAE, RMSE, R2, MAPE (denominator y + 1) and median absolute error per model.

    Input: keys, ``actual``, ``predicted``. The median is exact and needs no single-task sort.
    """
    err = F.col("predicted") - F.col("actual")
    rows = predictions.withColumn("_abs", F.abs(err))
    sums = rows.groupBy(*keys).agg(
        F.avg("_abs").alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        (1 - F.try_divide(F.avg(err * err), F.var_pop("actual"))).alias("r2"),
        (F.avg(F.abs(err / (F.col("actual") + 1))) * 100).alias("mape"),
    )
    median = exact_quantiles(rows, list(keys), "_abs", {"median_ae": 0.5}, cuts)
    return sums.join(median, list(keys), "left")


def feature_importance(model: PipelineModel, inputs: Sequence[str]) -> DataFrame:
    """From the fitted trees: one row per input column."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(inputs, weights)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def clv_percentiles(predictions: DataFrame, actuals: DataFrame, cuts=None) -> DataFrame:
    """Share (in percent) of actual values strictly below each prediction.

    Input: ``(account_id, predicted_clv)`` and ``(clv_12m)``. Both sides are reduced to distinct values,
    one running count answers all predictions at once, and each value is then looked up by equality.
    """
    values = (
        actuals.select(F.col("clv_12m").cast("double").alias("value"), F.lit(1).alias("n"))
        .unionByName(predictions.select(F.col("predicted_clv").alias("value"), F.lit(0).alias("n")))
        .where(F.col("value").isNotNull())
        .groupBy("value").agg(F.sum("n").alias("n"))
    )
    ranked = running_totals(values, [], "value", ["n"], cuts).select(
        F.col("value").alias("predicted_clv"),
        rate(100 * (F.col("cum_n") - F.col("n")), F.col("total_n")).alias("below"),  # one rounding: halves stay halves
    )
    return predictions.join(ranked, "predicted_clv", "left").select(
        *predictions.columns, F.round("below", 1).alias("clv_percentile")
    )


def permutation_importance(model: PipelineModel, frame: DataFrame, inputs: Sequence[str], seed: int = 7) -> DataFrame:
    """Rise of the mean squared error when one input is taken from another account.

    Accounts are paired by their ranks in two independent hash orders, a permutation found by one equi-join.
    Every row then appears once per input with that input exchanged, and once unchanged.
    """
    row = F.array(*[F.col(c).cast("double") for c in inputs])
    base = frame.select("account_id", F.col("log_target").alias("y"), row.alias("x"))
    left = _hash_rank(base, f"{seed}a").withColumnRenamed("_rank", "_slot")
    right = _hash_rank(base, f"{seed}b").groupBy("_rank").agg(F.min_by("x", "account_id").alias("other"))
    paired = left.join(right, F.col("_slot") == F.col("_rank"), "left")
    which = F.sequence(F.lit(-1), F.lit(len(inputs) - 1))
    versions = paired.select("y", "x", F.coalesce("other", "x").alias("other"), F.explode(which).alias("swap"))
    mixed = F.transform("x", lambda v, i: F.when(i == F.col("swap"), F.col("other")[i]).otherwise(v))
    scored = model.stages[-1].transform(versions.select("y", "swap", array_to_vector(mixed).alias("_inputs")))
    err = F.col("prediction") - F.col("y")
    mse = scored.groupBy("swap").agg(F.avg(err * err).alias("mse"))
    plain = mse.where(F.col("swap") == -1).select("mse").scalar()
    names = F.array(*[F.lit(c) for c in inputs])
    return mse.where(F.col("swap") >= 0).select(
        F.get(names, F.col("swap")).alias("feature"), (F.col("mse") - plain).alias("importance")
    )


def _hash_rank(df: DataFrame, salt: str) -> DataFrame:
    """Zero-based position in the order of a 64-bit hash of the account id."""
    hashed = df.withColumn("_h", F.xxhash64(F.lit(salt), F.col("account_id")))
    n = max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = [2.0**64 * i / n - 2.0**63 for i in range(1, n)]
    counted = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_totals(counted, [], "_h", ["_n"], cuts).select(
        F.col("_h").alias("_hr"), (F.col("cum__n") - F.col("_n")).alias("_rank")
    )
    return hashed.join(ranks, F.col("_h") == F.col("_hr")).drop("_h", "_hr")
