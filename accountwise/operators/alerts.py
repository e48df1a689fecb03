"""Alert tables. Delivery is left to whoever reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwise.config import PRODUCTS, product_slug
from accountwise.functions.columns import lookup
from accountwise.operators.ranking import exact_quantiles, top_n


def churn_alert(churn: DataFrame, n: int = 5) -> DataFrame:
    high = churn.where(F.col("risk_level") == "High")
    return top_n(high, [F.desc("churn_risk_score"), F.asc("account_id")], n).select(
        "account_id", "churn_risk_score", "risk_level", "industry", "tier", "expected_renewal_date",
        "support_ticket_count",
    )


def alert_payloads(churn: DataFrame) -> DataFrame:
    """One JSON message per High account."""
    high = churn.where(F.col("risk_level") == "High")
    account = F.col("account_id").cast("string")
    message = F.concat(F.lit("URGENT: High Churn Risk Detected for Account "), account)
    return high.select("account_id", F.to_json(F.struct(
        account.alias("account_id"), F.col("churn_risk_score").alias("churn_score"), "risk_level",
        message.alias("message"), F.lit("Create Retention Ticket").alias("action_required"),
    )).alias("payload"))


def crm_opportunities(cross_sell: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Ranked next-best products above a score, with a campaign tag per product."""
    tags = {p: f"campaign_{product_slug(p)}" for p in PRODUCTS}
    return cross_sell.where(F.col("probability_score") > min_score).select(
        "account_id", "recommendation_rank", "recommended_product", "probability_score",
        lookup(F.col("recommended_product"), tags, "campaign_other").alias("campaign_tag"),
    )


def outreach_candidates(churn: DataFrame, features: DataFrame, share: float = 0.75, cuts=None) -> DataFrame:
    """High churn, customer value at or above a quantile, not churned."""
    bar = exact_quantiles(features, [], "clv_12m", {"bar": share}, cuts).select("bar").scalar()
    rich = features.where((F.col("clv_12m") >= bar) & ~F.coalesce("is_churned", F.lit(False)))
    return rich.select("account_id", "clv_12m").join(
        churn.where(F.col("risk_level") == "High").select("account_id", "churn_risk_score"), "account_id"
    )
