"""Segmentation: standardised inputs, map projection, density clusters, rule labels, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwise.config import SEGMENT_FEATURES
from accountwise.functions.columns import rate
from accountwise.operators.ranking import exact_quantiles, melt
from accountwise.operators.scaling import Scaler, fit_scaler
from accountwise.session import cut_lineage, written_again

PROFILE_MEDIANS = (
    "clv_12m", "booking_volume_trend", "cancellation_rate_90d", "ticket_rate_per_month",
    "num_active_products", "total_spend_90d",
)
NOISE = -1


def segmentation_frame(
    features: DataFrame, columns: Sequence[str] = SEGMENT_FEATURES, scaler: Scaler | None = None
) -> tuple[DataFrame, Scaler]:
    plain = features.select("account_id", *columns).na.fill(0, list(columns))
    scaler = scaler or fit_scaler(plain, columns)
    return scaler.transform(plain), scaler


def principal_map(frame: DataFrame, columns: Sequence[str] = SEGMENT_FEATURES, k: int = 2) -> DataFrame:
    """Coordinates ``pc_0 .. pc_k-1`` of each account on the first principal axes."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(frame.select("account_id", *columns))
    fitted = PCA(k=k, inputCol="_x", outputCol="_pc").fit(assembled)
    return fitted.transform(assembled).select(
        "account_id", *[vector_to_array("_pc")[i].alias(f"pc_{i}") for i in range(k)]
    )


def _neighbours(cells: DataFrame, axes: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every cell announces itself to the cells around it (itself included): 3^k rows per cell."""
    steps = F.array(*[
        F.struct(*[F.lit(s).alias(f"_s{i}") for i, s in enumerate(step)])
        for step in product((-1, 0, 1), repeat=len(axes))
    ])
    return cells.select(*axes, *columns, F.inline(steps)).select(
        *[(F.col(a) + F.col(f"_s{i}")).alias(a) for i, a in enumerate(axes)], *columns
    )


def connected_labels(core: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Smallest cell name reachable through adjacent core cells.

    Each round takes the best label among the neighbours, then jumps to the label of that label, which
    shortens long chains. Every round is stored in the shared folder; it ends when no label changes.
    """
    name = F.concat_ws(",", *[F.col(a).cast("string") for a in axes])
    labels = written_again(core.select(*axes, name.alias("cell"), name.alias("label")))
    while True:
        seen = _neighbours(labels, axes, ["label"]).groupBy(*axes).agg(F.min("label").alias("near"))
        lowered = labels.join(seen, list(axes)).select(
            *axes, "cell", "label", F.least("label", "near").alias("next")
        )
        roots = lowered.select(F.col("cell").alias("_root"), F.col("next").alias("_jump"))
        stepped = written_again(
            lowered.join(roots, F.col("next") == F.col("_root"), "left").select(
                *axes, "cell", F.least("next", F.coalesce("_jump", "next")).alias("label"),
                F.col("label").alias("old"),
            )
        )
        labels = stepped.drop("old")
        if stepped.where(F.col("label") != F.col("old")).isEmpty():
            return labels.select(*axes, "label")


def density_clusters(
    points: DataFrame, axes: Sequence[str], cell: float = 0.5, min_neighbours: int = 20, min_size: int = 100
) -> DataFrame:
    """Density clustering on a grid; noise is -1, clusters are numbered by size from 0.

    Accounts are first counted per cell, so identical or crowded accounts cost one row. A cell is core
    when it and the cells around it hold at least ``min_neighbours`` accounts; adjacent core cells form a
    cluster; a cell next to a core cell belongs to it; clusters below ``min_size`` accounts are noise.
    No pair of accounts is ever formed.
    """
    at = [F.floor(F.col(a) / F.lit(cell)).cast("bigint").alias(f"g_{i}") for i, a in enumerate(axes)]
    grid = [f"g_{i}" for i in range(len(axes))]
    placed = points.select("account_id", *at)
    cells = cut_lineage(placed.groupBy(*grid).agg(F.count(F.lit(1)).alias("n")))
    crowd = _neighbours(cells, grid, ["n"]).groupBy(*grid).agg(F.sum("n").alias("crowd"))
    core = cells.join(crowd, grid).where(F.col("crowd") >= min_neighbours).select(*grid)
    labels = connected_labels(core, grid)
    # a core cell keeps its own label; a border cell takes the smallest label next to it
    own = labels.select(*grid, F.col("label").alias("own"))
    near = _neighbours(labels, grid, ["label"]).groupBy(*grid).agg(F.min("label").alias("near"))
    owned = cells.join(near, grid, "left").join(own, grid, "left").select(
        *grid, "n", F.coalesce("own", "near").alias("label")
    )
    sizes = owned.where(F.col("label").isNotNull()).groupBy("label").agg(F.sum("n").alias("size"))
    # few rows: one per cluster of at least min_size accounts
    rank = Window.partitionBy(F.lit(0)).orderBy(F.desc("size"), "label")
    kept = sizes.where(F.col("size") >= min_size).withColumn("cluster", (F.row_number().over(rank) - 1).cast("int"))
    cell_cluster = owned.join(kept, "label", "left").select(
        *grid, F.coalesce("cluster", F.lit(NOISE)).alias("cluster")
    )
    return placed.join(cell_cluster, grid).select("account_id", "cluster")


def kmeans_clusters(frame: DataFrame, columns: Sequence[str] = SEGMENT_FEATURES, k: int = 5, seed: int = 42) -> DataFrame:
    """Alternative without noise."""
    data = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(frame.select("account_id", *columns))
    return KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cluster").fit(data).transform(data).select(
        "account_id", "cluster"
    )


def cluster_sizes(clusters: DataFrame) -> DataFrame:
    """Accounts and share per cluster (noise included)."""
    counts = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("accounts"))
    total = F.sum("accounts").over(Window.partitionBy(F.lit(0)))  # one row per cluster
    return counts.select("cluster", "accounts", (rate(F.col("accounts"), total) * 100).alias("percent"))


def calinski_harabasz(frame: DataFrame, columns: Sequence[str] = SEGMENT_FEATURES) -> DataFrame:
    """Between / within dispersion from per-cluster sums, noise excluded; 0 below two clusters."""
    long = melt(frame.where(F.col("cluster") != NOISE), ["cluster"], columns, "feature", "value")
    cell = long.groupBy("cluster", "feature").agg(
        F.count("value").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss")
    )
    per_feature = cell.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("ss").alias("ss"), F.sum("s").alias("s"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("centred"),
    )
    between = F.sum(F.col("centred") - F.col("s") * F.col("s") / F.col("n"))
    within = F.sum(F.col("ss") - F.col("centred"))
    k, n = F.max("k"), F.max("n")
    score = F.when(k > 1, F.try_divide(between / (k - 1), within / (n - k))).otherwise(0.0)
    return per_feature.agg(
        k.alias("clusters"), n.alias("accounts"), F.coalesce(score, F.lit(0.0)).alias("calinski_harabasz")
    )


def silhouette(frame: DataFrame, columns: Sequence[str] = SEGMENT_FEATURES) -> float:
    """Mean silhouette under the squared Euclidean distance, noise excluded; 0 below two clusters."""
    valid = frame.where(F.col("cluster") != NOISE)
    if valid.select("cluster").distinct().limit(2).count() < 2:
        return 0.0
    data = VectorAssembler(inputCols=list(columns), outputCol="features").transform(valid)
    return ClusteringEvaluator(predictionCol="cluster", featuresCol="features").evaluate(data)


def cluster_profiles(clustered: DataFrame, cuts=None) -> DataFrame:
    """Exact medians and churn share per cluster, rounded to three digits."""
    long = melt(clustered, ["cluster"], PROFILE_MEDIANS, "feature", "value")
    medians = exact_quantiles(long, ["cluster", "feature"], "value", {"median": 0.5}, cuts)
    wide = medians.groupBy("cluster").pivot("feature", list(PROFILE_MEDIANS)).agg(F.first("median"))
    churn = clustered.groupBy("cluster").agg(F.avg(F.col("is_churned").cast("double")).alias("churn_rate"))
    rounded = [F.round(c, 3).alias(c) for c in (*PROFILE_MEDIANS, "churn_rate")]
    return wide.join(churn, "cluster").select("cluster", *rounded)


def label_rules(rank: Column) -> Column:
    churn, trend = F.col("churn_rate"), F.col("booking_volume_trend")
    trouble = (churn > 0.15) | (F.col("cancellation_rate_90d") > 0.15) | (F.col("ticket_rate_per_month") > 1.5)
    return (
        F.when(F.col("cluster") == NOISE, "Unassigned")
        .when((rank >= 0.7) & (churn < 0.2) & (F.col("num_active_products") >= 2), "Platinum Partners")
        .when((trend > 0) & (rank >= 0.4), "Growth Accounts")
        .when(trouble, "At-Risk Accounts")
        .otherwise("Low-Engagement")
    )


def label_clusters(profiles: DataFrame) -> DataFrame:
    """Segment name per cluster. The value rank averages ties and counts the noise cluster.

    Windows run over one row per cluster.
    """
    everything = Window.partitionBy(F.lit(0))
    ties = F.count(F.lit(1)).over(Window.partitionBy("clv_12m"))
    place = F.rank().over(everything.orderBy("clv_12m")) + (ties - 1) / F.lit(2.0)
    ranked = profiles.withColumn("clv_rank", place / F.count(F.lit(1)).over(everything))
    return ranked.select("cluster", "clv_rank", label_rules(F.col("clv_rank")).alias("segment"))


def label_accounts(clustered: DataFrame, cuts=None) -> DataFrame:
    labels = label_clusters(cluster_profiles(clustered, cuts)).select("cluster", "segment")
    return clustered.join(labels, "cluster").select("account_id", "cluster", "segment")


def segment_summary(segmented: DataFrame) -> DataFrame:
    """Input: features with ``segment``."""
    return segmented.where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count("account_id").alias("accounts"), F.round(F.avg("clv_12m"), 2).alias("avg_clv"),
        F.round(F.avg("total_spend_90d"), 2).alias("avg_spend_90d"),
        F.round(F.avg(F.col("is_churned").cast("double")), 2).alias("churn_rate"),
        F.round(F.avg("num_active_products"), 2).alias("avg_products"),
    )
