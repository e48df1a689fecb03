"""Account and portfolio queries. Batch over all accounts; filters are parameters, not separate code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.config import HIGH_RISK, PRODUCT_FLAGS, PRODUCTS, SURVIVAL_HORIZONS
from accountwise.functions.columns import rate, risk_level
from accountwise.operators.cross_sell import ranked_offers
from accountwise.operators.ranking import exact_quantiles, top_n

MAX_PAGE = 100


def _only(df: DataFrame, account_id) -> DataFrame:
    return df if account_id is None else df.where(F.col("account_id") == F.lit(account_id))


def churn_lookup(churn: DataFrame, account_id=None) -> DataFrame:
    score = F.col("churn_risk_score")
    return _only(churn, account_id).select(
        "account_id", F.round(score, 4).alias("churn_risk_score"),
        *[F.round(f"survival_prob_{h}d", 4).alias(f"survival_prob_{h}d") for h in SURVIVAL_HORIZONS],
        risk_level(score).alias("risk_level"),
    )


def cross_sell_lookup(probabilities: DataFrame, top: int = 3, account_id=None) -> DataFrame:
    """Best offers as an array of (product, propensity_score) and the products already held."""
    return ranked_offers(_only(probabilities, account_id), digits=4).select(
        "account_id", offer_list(top, "propensity_score").alias("recommendations"), "current_products"
    )


def offer_list(top: int, score_name: str) -> Column:
    return F.transform(
        F.slice("offers", 1, top),
        lambda o: F.struct(o["product"].alias("product"), F.round(o["score"], 4).alias(score_name)),
    )


def account_page(
    features: DataFrame, segments: DataFrame, tier: str | None = None, segment: str | None = None,
    limit: int = 50, offset: int = 0,
) -> DataFrame:
    """One page of accounts ordered by id, with the number of matching accounts on every row."""
    if not 1 <= limit <= MAX_PAGE or offset < 0:
        raise ValueError(f"limit must be 1..{MAX_PAGE} and offset >= 0")
    rows = features.join(segments.select("account_id", "segment"), "account_id", "left")
    if tier:
        rows = rows.where(F.col("tier") == tier)
    if segment:
        rows = rows.where(F.col("segment") == segment)
    total = rows.agg(F.count(F.lit(1))).scalar()
    return _page_columns(rows.orderBy("account_id").offset(offset).limit(limit), total)


def page_after(
    spark: SparkSession, path: str, after=None, tier: str | None = None, segment: str | None = None, limit: int = 50
) -> DataFrame:
    """The page behind an account id, from a table of ``writers.write_pages``: the same rows as an offset, at any depth.

    The index names the ranges that hold the page and has the number of matching accounts; no other file is read.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be 1..{MAX_PAGE}")

    def matching(rows: DataFrame) -> DataFrame:
        if tier:
            rows = rows.where(F.col("tier") == tier)
        return rows.where(F.col("segment") == segment) if segment else rows

    index = matching(spark.read.parquet(f"{path}/index"))
    total = index.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    ranges = index.groupBy("page_file", "page_range").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    if after is not None:
        ranges = ranges.where(F.col("last") > after)
    # the first range may hold only one match behind the id, every other one all of its own
    chosen, sure = [], 1
    for r in ranges.orderBy("page_range").limit(limit).collect():
        chosen.append((r["page_file"], r["page_range"]))
        sure += r["n"] if len(chosen) > 1 else 0
        if sure >= limit:
            break
    files, ranges = {file for file, _ in chosen}, [at for _, at in chosen]
    rows = matching(spark.read.parquet(f"{path}/rows").where(F.col("page_file").isin(files) & F.col("page_range").isin(ranges)))
    if after is not None:
        rows = rows.where(F.col("account_id") > after)
    return _page_columns(rows.orderBy("account_id").limit(limit), total)


def _page_columns(page: DataFrame, total: Column) -> DataFrame:
    return page.select(
        "account_id", "tier", "region", "industry", F.round("clv_12m", 2).alias("clv_12m"), "is_churned",
        "booking_count_90d", F.round("total_spend_90d", 2).alias("total_spend_90d"), "num_active_products",
        "segment", total.alias("total"),
    )


def account_profile(
    features: DataFrame, churn: DataFrame, segments: DataFrame, probabilities: DataFrame, account_id=None
) -> DataFrame:
    """Account 360: one row per account. All sides have one row per account."""
    score = F.col("churn_risk_score")
    joined = (
        _only(features, account_id)
        .join(churn.select("account_id", "churn_risk_score", F.lit(True).alias("_scored")), "account_id", "left")
        .join(segments.select("account_id", "segment"), "account_id", "left")
        .join(ranked_offers(probabilities, digits=4), "account_id", "left")
    )
    unknown = lambda c: F.coalesce(c, F.lit("Unknown"))
    return joined.select(
        "account_id", unknown("tier").alias("tier"), unknown("industry").alias("industry"),
        unknown("region").alias("region"), F.round("clv_12m", 2).alias("clv_12m"),
        F.coalesce(F.round(score, 4), F.lit(0.0)).alias("churn_risk_score"),
        F.when(F.col("_scored"), risk_level(score)).otherwise("Unknown").alias("risk_level"),
        unknown("segment").alias("segment"),
        F.coalesce(offer_list(3, "score"), F.array().cast("array<struct<product:string,score:double>>"))
        .alias("top_recommendations"),
        F.coalesce("current_products", F.array().cast("array<string>")).alias("current_products"),
        F.struct(
            "booking_count_90d", F.round("total_spend_90d", 2).alias("total_spend_90d"), "num_active_products",
            F.round("ticket_rate_per_month", 2).alias("ticket_rate_per_month"),
            F.round("cancellation_rate_90d", 4).alias("cancellation_rate_90d"), "tenure_days",
        ).alias("key_metrics"),
    )


def _segment_measures() -> list[Column]:
    return [
        F.count("account_id").alias("accounts"), F.round(F.avg("clv_12m"), 2).alias("avg_clv"),
        F.round(F.sum(F.col("clv_12m").cast("decimal(20,2)")).cast("double"), 2).alias("total_clv"),
        F.round(F.avg("total_spend_90d"), 2).alias("avg_spend_90d"),
        F.round(F.avg(F.col("is_churned").cast("double")), 2).alias("churn_rate"),
        F.round(F.avg("num_active_products"), 2).alias("avg_products"),
    ]


def segment_overview(features: DataFrame, segments: DataFrame) -> DataFrame:
    """Aggregates per segment; accounts without a segment are left out."""
    rows = features.join(segments.select("account_id", "segment"), "account_id", "left")
    return rows.where(F.col("segment").isNotNull()).groupBy("segment").agg(
        *_segment_measures(), F.round(F.avg("booking_count_90d"), 2).alias("avg_bookings_90d")
    )


def master_table(
    features: DataFrame, segments: DataFrame, churn: DataFrame, recommendations: DataFrame
) -> DataFrame:
    extra = [c for c in ("map_x", "map_y") if c in segments.columns]
    return (
        features.join(segments.select("account_id", "segment", *extra), "account_id", "left")
        .join(churn.select("account_id", "churn_risk_score", "survival_prob_365d"), "account_id", "left")
        .join(
            recommendations.select("account_id", "top_1_product", "top_1_score", "top_2_product", "top_2_score"),
            "account_id", "left",
        )
    )


def portfolio_kpis(master: DataFrame) -> DataFrame:
    return master.agg(
        F.sum(F.col("clv_12m").cast("decimal(20,2)")).cast("double").alias("total_clv"),
        F.avg("clv_12m").alias("avg_clv"),
        (F.avg(F.col("is_churned").cast("double")) * 100).alias("churn_percent"),
        F.count_if(F.col("churn_risk_score") > HIGH_RISK).alias("high_risk_accounts"),
        F.avg("num_active_products").alias("avg_products"),
    )


def clv_by_tier(master: DataFrame, cuts=None) -> DataFrame:
    """Box-plot statistics, exact."""
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return exact_quantiles(master, ["tier"], "clv_12m", probs, cuts)


def segment_distribution(segments: DataFrame) -> DataFrame:
    return segments.where(F.col("segment").isNotNull()).groupBy("segment").agg(F.count(F.lit(1)).alias("accounts"))


def revenue_at_risk(master: DataFrame, n: int = 15) -> DataFrame:
    risky = master.where(F.col("churn_risk_score") > HIGH_RISK)
    return top_n(risky, [F.desc("clv_12m"), F.asc("account_id")], n).select(
        "account_id", "clv_12m", "churn_risk_score"
    )


def product_penetration(features: DataFrame) -> DataFrame:
    shares = features.agg(*[(F.avg(flag) * 100).alias(p) for p, flag in PRODUCT_FLAGS.items()])
    return shares.unpivot([], list(PRODUCTS), "product", "adoption_percent")


def explorer(
    master: DataFrame, tiers: Sequence[str] = (), segments: Sequence[str] = (), search: str = "", n: int = 100
) -> DataFrame:
    """Filtered accounts, best customer value first. ``search`` is a case-insensitive regex on the id."""
    rows = master
    if tiers:
        rows = rows.where(F.col("tier").isin(*tiers))
    if segments:
        rows = rows.where(F.col("segment").isin(*segments))
    if search:
        rows = rows.where(F.col("account_id").cast("string").rlike(f"(?i){search}"))
    return top_n(rows, [F.desc("clv_12m"), F.asc("account_id")], n).select(
        "account_id", "tier", "industry", "region", "clv_12m", "booking_count_90d", "total_spend_90d",
        "num_active_products", "segment", "churn_risk_score", "top_1_product",
    )


def segment_breakdown(master: DataFrame) -> DataFrame:
    return master.where(F.col("segment").isNotNull()).groupBy("segment").agg(*_segment_measures())


def propensity_matrix(master: DataFrame, probabilities: DataFrame, n: int = 50) -> DataFrame:
    """Scores of the accounts with the highest value: the top-n is cut before the join."""
    best = top_n(master.select("account_id", "clv_12m"), [F.desc("clv_12m"), F.asc("account_id")], n)
    return best.join(
        probabilities.select("account_id", *[F.col(f"`{p}_score`") for p in PRODUCTS]), "account_id", "left"
    )


def top_recommendation_by_segment(master: DataFrame) -> DataFrame:
    """Most frequent first offer (ties: smallest name) and the mean first score per segment."""
    rows = master.where(F.col("segment").isNotNull())
    counts = rows.groupBy("segment", "top_1_product").agg(
        F.count(F.lit(1)).alias("n"), F.sum("top_1_score").alias("s"), F.count("top_1_score").alias("k")
    )
    # one row per segment and product from here on
    named = F.col("top_1_product").isNotNull()
    return (
        counts.groupBy("segment")
        .agg(
            F.min(F.when(named, F.struct((-F.col("n")).alias("order"), "top_1_product")))["top_1_product"]
            .alias("top_product"),
            rate(F.sum("s"), F.sum("k")).alias("avg_score"),
        )
        .where(F.col("top_product").isNotNull())
    )


def outreach_context(profile: DataFrame) -> DataFrame:
    """Formatted account facts for whoever writes the message."""
    m = F.col("key_metrics")
    money = lambda c: F.concat(F.lit("$"), F.format_number(c, 2))
    return profile.select(
        "account_id", "industry", F.col("tier").alias("clv_tier"), money(F.col("clv_12m")).alias("clv_predicted"),
        F.col("risk_level").alias("churn_risk_level"),
        F.when(F.size("current_products") > 0, F.array_join("current_products", ", ")).otherwise("None")
        .alias("current_products"),
        F.coalesce(F.get("top_recommendations", F.lit(0))["product"], F.lit("None")).alias("top_recommendation"),
        F.concat(
            F.lit("Spend: "), money(m["total_spend_90d"]), F.lit(", Bookings: "), m["booking_count_90d"].cast("string"),
            F.lit(", Support Tickets/Mo: "), m["ticket_rate_per_month"].cast("string"),
        ).alias("recent_performance"),
    )
