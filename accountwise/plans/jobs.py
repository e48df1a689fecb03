"""The batch jobs a user schedules: load, marts, labels, features, models, checks.

Every job reads tables from a folder, writes tables to a folder and returns the written paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.config import PRODUCT_FLAGS, Params
from accountwise.operators import assemble, attribution, clv, cross_sell, density, labels, quality, segments, survival
from accountwise.operators.staging import bookings_with_account
from accountwise.session import cut_lineage
from accountwise.sources import manifest, readers, writers
from accountwise.sources.schemas import ENTITY_TABLES, LOGICAL_NAME, PREDICTIONS, RAW


def load_raw(spark: SparkSession, folder: str, out: str, names: Sequence[str] = tuple(RAW)) -> DataFrame:
    """CSV files ``<folder>/<table>.csv`` into the raw layer; bad rows go to the quarantine."""
    counts = writers.load_raw_layer(spark, {n: f"{folder}/{n}.csv" for n in names}, out)
    counts.write.mode("overwrite").parquet(f"{out}/load_counts")
    return counts


def _entities(spark: SparkSession, folder: str, fmt: str = "auto", names: Sequence[str] = ENTITY_TABLES) -> dict:
    return readers.load_tables(spark, folder, fmt, names, optional=("clv_labels",))


def build_marts(
    spark: SparkSession, folder: str, out: str, as_of: date, without_predictions: bool = False
) -> dict[str, DataFrame]:
    """Staging views and marts. Fails without published predictions, unless told to do without."""
    tables = readers.load_tables(spark, folder, names=tuple(RAW), optional=("clv_labels", *PREDICTIONS))
    return writers.write_layers(tables, as_of, out, without_predictions)


def publish_predictions(spark: SparkSession, models: str, raw: str) -> dict[str, str]:
    """Scored churn and recommendations into the raw layer that the marts read: by name, in its types."""
    out = {}
    for name, table in (("churn_predictions", "churn_predictions"), ("recommendations", "cross_sell_recommendations")):
        scored = spark.read.parquet(f"{models}/{writers.PREDICTION_FOLDERS[name]}")
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in readers.schema_of(RAW[table])]
        out[table] = _save(scored.select(*typed), f"{raw}/{table}.parquet")
    return out


def build_labels(spark: SparkSession, folder: str, out: str, p: Params) -> str:
    t = _entities(spark, folder)
    owned = bookings_with_account(t["bookings"], t["travelers"], "inner")
    path = f"{out}/clv_labels.parquet"
    labels.clv_labels(t["accounts"], owned, t["contracts"], t["tickets"], p).write.mode("overwrite").parquet(path)
    return path


def build_features(
    spark: SparkSession, folder: str, out: str, p: Params, fmt: str = "both", feature_ts: datetime | None = None,
    source: str = "local", namespace: str = "staging", prefix: str = "",
) -> list[str]:
    """The feature matrix from files or from catalog tables. Stored labels are used when present."""
    t = (_entities(spark, folder) if source == "local"
         else readers.read_catalog_tables(spark, namespace, prefix=prefix))
    stored = t.pop("clv_labels", None)
    t["bookings"] = bookings_with_account(t["bookings"], t["travelers"], "inner")
    matrix = assemble.account_features(t, p, feature_ts or datetime.now(), stored)
    paths = writers.write_features(matrix, out, fmt)
    if fmt != "csv":
        matrix = spark.read.parquet(paths[0])
    assemble.feature_statistics(matrix).write.mode("overwrite").parquet(f"{out}/feature_statistics")
    return paths


def _save(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def train_clv(
    spark: SparkSession, features: str, out: str, tune: bool = True, rounds: int = 500, depth: int = 6,
    trees: int = 100, points: int = 50, explained: int | None = None,
) -> dict[str, str]:
    """Boosted trees and the benchmark forest: search, models, comparison, importances, attributions and scores.

    ``points`` settings are searched; ``explained`` limits the test accounts whose predictions are attributed.
    """
    matrix = spark.read.parquet(features)
    inputs = assemble.model_inputs(matrix)
    frame = cut_lineage(clv.training_frame(matrix, inputs))
    trials = clv.search_boosted(frame, inputs, points, rounds=rounds) if tune else []
    models = {
        "boosted": clv.fit_boosted(frame, inputs, rounds, depth, setting=clv.best_setting(trials) if tune else None),
        "forest": clv.fit_forest(frame, inputs, trees, depth),
    }
    test, compared = frame.where(F.col("split") == "test"), None
    for name, model in models.items():
        model.write().overwrite().save(f"{out}/clv/model_{name}")
        rows = clv.score(model, test).select(
            F.lit(name).alias("model"), F.col("clv_12m").alias("actual"), F.col("predicted_clv").alias("predicted")
        )
        compared = rows if compared is None else compared.unionByName(rows)
    best = models["boosted"]
    scores = cut_lineage(clv.score(best, matrix).select("account_id", "tier", "predicted_clv"))
    values = cut_lineage(attribution.row_attributions(best, test, inputs, explained))
    return {
        "trials": _save(clv.trial_table(spark, trials), f"{out}/clv/trials"),
        "attributions": _save(attribution.long_attributions(values, inputs), f"{out}/clv/attributions"),
        "attribution_importance": _save(attribution.attribution_importance(values, inputs), f"{out}/clv/attribution_importance"),
        "model_comparison": _save(clv.regression_metrics(cut_lineage(compared)), f"{out}/clv/model_comparison"),
        "feature_importance": _save(clv.feature_importance(best, inputs), f"{out}/clv/feature_importance"),
        "permutation_importance": _save(
            clv.permutation_importance(best, test, inputs), f"{out}/clv/permutation_importance"),
        "scores": _save(clv.clv_percentiles(scores, matrix), f"{out}/clv/clv_scores"),
    }


def train_survival(spark: SparkSession, features: str, out: str, penalty: float = 0.01) -> dict[str, str]:
    """Survival tables, Cox summary, concordance, and churn predictions for every account."""
    matrix = spark.read.parquet(features)
    frame, _ = survival.survival_frame(matrix)
    frame = cut_lineage(frame.join(matrix.select("account_id", "tier"), "account_id"))
    model = survival.fit_cox(frame, penalty=penalty)
    curve = survival.kaplan_meier(frame)
    risk = cut_lineage(survival.score_churn(model, frame))
    ranked = frame.select("account_id", "duration", "event").join(
        risk.select("account_id", F.col("partial_hazard").alias("risk")), "account_id"
    )
    base = f"{out}/survival"
    return {
        "kaplan_meier": _save(curve, f"{base}/kaplan_meier"),
        "kaplan_meier_by_tier": _save(survival.kaplan_meier(frame, "tier", 10), f"{base}/kaplan_meier_by_tier"),
        "median_survival": _save(survival.median_survival(curve), f"{base}/median_survival"),
        "cox_summary": _save(model.summary(spark), f"{base}/cox_ph_summary"),
        "concordance": _save(survival.concordance(ranked), f"{base}/concordance"),
        "churn_predictions": _save(risk, f"{base}/churn_risk_predictions"),
        "risk_histogram": _save(survival.risk_histogram(risk), f"{base}/risk_histogram"),
    }


def segment_accounts(
    spark: SparkSession, features: str, out: str, reach: float = 1.0, min_neighbours: int = 20, min_size: int = 100,
    axes: int = 2,
) -> dict[str, str]:
    """Map, density clusters, their profiles and rule labels, and quality measures."""
    matrix = spark.read.parquet(features)
    frame, _ = segments.segmentation_frame(matrix)
    points = cut_lineage(segments.principal_map(frame, k=axes))
    names = [f"pc_{i}" for i in range(axes)]
    clusters = cut_lineage(density.density_hierarchy(points, names, reach, min_neighbours=min_neighbours, min_size=min_size))
    clustered = matrix.join(clusters, "account_id")
    profiles = cut_lineage(segments.cluster_profiles(clustered))
    labels = segments.label_clusters(profiles).select("cluster", "segment")
    labelled = cut_lineage(clustered.join(labels, "cluster").select("account_id", "cluster", "segment"))
    placed = labelled.join(
        points.select("account_id", F.col("pc_0").alias("map_x"), F.col("pc_1").alias("map_y")), "account_id"
    )
    standard = frame.join(clusters, "account_id")
    measures = segments.calinski_harabasz(standard).withColumn("silhouette", F.lit(float(segments.silhouette(standard))))
    named = matrix.join(labelled.select("account_id", "segment"), "account_id")
    base = f"{out}/segmentation"
    return {
        "segments": _save(placed, f"{base}/account_segments"),
        "cluster_sizes": _save(segments.cluster_sizes(clusters), f"{base}/cluster_sizes"),
        "cluster_profiles": _save(profiles, f"{base}/cluster_profiles"),
        "cluster_metrics": _save(measures, f"{base}/cluster_metrics"),
        "segment_summary": _save(segments.segment_summary(named), f"{base}/segment_summary"),
    }


def train_cross_sell(
    spark: SparkSession, features: str, out: str, rounds: int = 300, depth: int = 5
) -> dict[str, str]:
    """One classifier per product, metrics on the test split, scores and recommendations for every account."""
    matrix = spark.read.parquet(features)
    inputs = assemble.model_inputs(matrix, drop_product_flags=True)
    frame = cut_lineage(cross_sell.adoption_frame(matrix))
    models = cross_sell.fit_classifiers(frame.where(F.col("split") == "train"), inputs, rounds, depth)
    for product, model in models.items():
        model.write().overwrite().save(f"{out}/cross_sell/model_{PRODUCT_FLAGS[product]}")
    everyone = cut_lineage(cross_sell.probability_matrix(models, frame))
    held_out = everyone.join(frame.where(F.col("split") == "test").select("account_id"), "account_id", "left_semi")
    scores = cut_lineage(cross_sell.long_scores(held_out))
    recs = cross_sell.recommendations(everyone)
    base = f"{out}/cross_sell"
    return {
        "cross_sell_metrics": _save(cross_sell.ranking_metrics(scores), f"{base}/cross_sell_metrics"),
        "precision_recall": _save(cross_sell.precision_recall_curve(scores), f"{base}/precision_recall"),
        "probabilities": _save(everyone, f"{base}/cross_sell_probabilities"),
        "recommendations": _save(recs, f"{base}/account_recommendations"),
        "distribution": _save(cross_sell.recommendation_distribution(recs), f"{base}/recommendation_distribution"),
    }


def check_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts, required columns and NULL keys of the entity tables."""
    t = _entities(spark, folder)
    have = {LOGICAL_NAME[n]: LOGICAL_NAME[n] for n in ENTITY_TABLES if LOGICAL_NAME[n] in t}
    return (
        quality.row_counts({n: t[n] for n in have})
        .unionByName(quality.null_keys({n: t[n] for n in have}))
        .unionByName(quality.required_columns(spark, t))
    )


def check_features(spark: SparkSession, features: str) -> DataFrame:
    return quality.feature_gate(spark.read.parquet(features))


def write_manifest(spark: SparkSession, folder: str, out: str) -> str:
    return _save(manifest.manifest(spark, folder), out)
