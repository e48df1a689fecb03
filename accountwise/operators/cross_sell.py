"""Cross-sell: labels and split, classifiers, ranking metrics, recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwise.config import PRODUCT_FLAGS, PRODUCTS
from accountwise.functions.columns import rate
from accountwise.operators.assemble import model_inputs
from accountwise.operators.boosting import fit_together
from accountwise.operators.clv import hash_split
from accountwise.operators.ranking import running_totals
from accountwise.session import dealt_for_rounds

POSITIVE_WEIGHT = 5.0


def adoption_frame(features: DataFrame) -> DataFrame:
    """Adoption flags as labels, without the flags among the inputs, plus an 80/20 split."""
    kept = model_inputs(features, drop_product_flags=True)
    frame = features.select(
        "account_id", *kept, *[F.coalesce(F.col(f), F.lit(0)).cast("int").alias(f) for f in PRODUCT_FLAGS.values()]
    )
    return hash_split(frame, "account_id", {"train": 0.8, "test": 0.2}, salt="cross-sell")


def adoption_rates(frame: DataFrame) -> DataFrame:
    return (
        frame.groupBy("split").agg(
            F.count(F.lit(1)).alias("accounts"),
            *[F.sum(f).alias(f) for f in PRODUCT_FLAGS.values()],
        )
        .unpivot(["split", "accounts"], list(PRODUCT_FLAGS.values()), "flag", "adopters")
        .withColumn("adoption_rate", rate(F.col("adopters"), F.col("accounts")))
    )


def fit_classifiers(
    train: DataFrame, inputs: Sequence[str], rounds: int = 300, depth: int = 5, step: float = 0.05, seed: int = 42
) -> dict[str, PipelineModel]:
    """One boosted classifier per product, grown together; adopters weigh more because they are few.

    The input vector is assembled once and stored for all of them.
    """
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="_inputs")
    assembled = dealt_for_rounds(assembler.transform(train).select("account_id", "_inputs", *PRODUCT_FLAGS.values()), "account_id")

    learners = {
        flag: GBTClassifier(
            featuresCol="_inputs", labelCol=flag, weightCol="_weight", maxIter=rounds, maxDepth=depth,
            stepSize=step, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed, cacheNodeIds=False,
        )
        for flag in PRODUCT_FLAGS.values()
    }
    fitted = fit_together(assembled, learners, POSITIVE_WEIGHT)
    return {product: PipelineModel([assembler, model]) for product, model in zip(PRODUCT_FLAGS, fitted)}


def probability_matrix(models: dict[str, PipelineModel], features: DataFrame) -> DataFrame:
    """``<product>_score`` and ``<product>_current`` per account, in one pass over the features."""
    scored = features
    for product, model in models.items():
        learner = model.stages[-1]
        if "_inputs" not in scored.columns:
            scored = model.stages[0].transform(scored)
        learner.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")  # the trees are walked for what is asked
        scored = learner.transform(scored).withColumn(f"{product}_score", vector_to_array("_p")[1]).drop("_p")
    cols = [F.col("account_id")]
    for product, flag in PRODUCT_FLAGS.items():
        cols += [F.col(f"`{product}_score`"), F.coalesce(F.col(flag), F.lit(0)).cast("int").alias(f"{product}_current")]
    return scored.select(*cols)


def matrix_from_long(scores: DataFrame) -> DataFrame:
    """Wide matrix from (account_id, product, score, is_current). The pivot values are given, so no extra pass."""
    wide = scores.groupBy("account_id").pivot("product", list(PRODUCTS)).agg(
        F.max("score").alias("score"), F.max("is_current").alias("current")
    )
    return wide


def ranked_offers(probabilities: DataFrame, digits: int | None = None) -> DataFrame:
    """Adds ``offers``: products not adopted yet, best score first, ties in product-list order; and
    ``current_products``. With ``digits`` scores are rounded first, so equal rounded scores are ties. The four scores sit in one row, so ranking is an array sort without a shuffle."""
    def score(product: str) -> Column:
        raw = F.col(f"`{product}_score`")
        return raw if digits is None else F.round(raw, digits)

    entry = [
        F.struct(
            score(product).alias("score"), F.lit(-i).alias("neg_order"),
            F.lit(product).alias("product"), F.col(f"`{product}_current`").alias("current"),
        )
        for i, product in enumerate(PRODUCTS)
    ]
    everything = F.array(*entry)
    return probabilities.select(
        "account_id",
        F.sort_array(F.filter(everything, lambda e: e["current"] == 0), asc=False).alias("offers"),
        F.transform(F.filter(everything, lambda e: e["current"] != 0), lambda e: e["product"])
        .alias("current_products"),
    )


def recommendations(probabilities: DataFrame) -> DataFrame:
    """Top two offers; without an offer the product is NULL and the score 0."""
    ranked = ranked_offers(probabilities)
    cols = [F.col("account_id")]
    for r in (1, 2):
        offer = F.try_element_at("offers", F.lit(r))
        cols += [offer["product"].alias(f"top_{r}_product"), F.coalesce(offer["score"], F.lit(0.0)).alias(f"top_{r}_score")]
    return ranked.select(*cols, F.size("current_products").alias("num_products_current"))


def recommendation_distribution(recs: DataFrame) -> DataFrame:
    return recs.where(F.col("top_1_product").isNotNull()).groupBy("top_1_product").agg(
        F.count(F.lit(1)).alias("accounts")
    ).orderBy(F.desc("accounts"), "top_1_product")


def long_scores(probabilities: DataFrame) -> DataFrame:
    """(account_id, product, score, label) in one scan."""
    entries = F.array(*[
        F.struct(F.lit(p).alias("product"), F.col(f"`{p}_score`").alias("score"), F.col(f"`{p}_current`").alias("label"))
        for p in PRODUCTS
    ])
    return probabilities.select("account_id", F.inline(entries))


def _threshold_counts(scores: DataFrame, cuts) -> DataFrame:
    """Per distinct score, best first: positives and negatives at it and up to it. Unscored rows (NULL or NaN) count nowhere."""
    counted = scores.groupBy("product", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    return running_totals(counted, ["product"], "score", ["pos", "neg"], cuts, descending=True)


def ranking_metrics(scores: DataFrame, threshold: float = 0.5, cuts=None) -> DataFrame:
    """AUC (pairs won, ties half), average precision (step sum), precision, recall, F1 and support."""
    at = _threshold_counts(scores, cuts)
    neg_before = F.col("cum_neg") - F.col("neg")
    pairs = F.col("total_pos").cast("double") * F.col("total_neg")
    won = F.sum(F.col("pos") * (F.col("total_neg") - neg_before - F.col("neg") / 2.0))
    precision_here = rate(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    hit = F.col("score") > threshold
    rows = at.groupBy("product").agg(
        F.coalesce(F.try_divide(won, F.max(pairs)), F.lit(0.0)).alias("auc_roc"),
        F.coalesce(F.try_divide(F.sum(F.col("pos") * precision_here), F.max("total_pos").cast("double")), F.lit(0.0))
        .alias("avg_precision"),
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.max("total_pos").alias("support"),
    )
    precision = F.coalesce(rate(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(rate(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(rate(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("support")), F.lit(0.0))
    return rows.select(
        "product", F.round("auc_roc", 4).alias("auc_roc"), F.round("avg_precision", 4).alias("avg_precision"),
        F.round(precision, 4).alias("precision"), F.round(recall, 4).alias("recall"), F.round(f1, 4).alias("f1"),
        "support",
    )


def precision_recall_curve(scores: DataFrame, cuts=None) -> DataFrame:
    """One point per distinct score."""
    return _threshold_counts(scores, cuts).select(
        "product", F.col("score").alias("threshold"),
        rate(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        rate(F.col("cum_pos"), F.col("total_pos")).alias("recall"),
    )
