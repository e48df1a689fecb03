"""Staging views: row in, row out, with the derived columns every mart relies on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwise.config import SEVERITY_COST, TIER_RANK
from accountwise.functions.columns import day, days_between, lookup, month_boundaries


def stg_corporate_accounts(accounts: DataFrame, as_of: date) -> DataFrame:
    return accounts.select(
        "account_id", "company_name", "industry", "region", "tier", "onboarding_date", "is_churned",
        "churn_date", "annual_contract_value",
        days_between(F.col("onboarding_date"), F.coalesce("churn_date", day(as_of))).alias("tenure_days"),
        lookup(F.col("tier"), TIER_RANK, 1).alias("tier_rank"),
    )


def bookings_with_account(bookings: DataFrame, travelers: DataFrame, how: str = "left") -> DataFrame:
    """Reach the account through the traveler.

    No broadcast hint: travelers grow with the data, so Spark broadcasts them only below its size
    threshold and otherwise sort-merge joins, where the adaptive skew join splits a hot traveler.
    """
    owner = travelers.select("traveler_id", "account_id")
    if how == "inner":
        owner = owner.where(F.col("account_id").isNotNull())
    return bookings.join(owner, "traveler_id", how)


def stg_bookings(bookings: DataFrame, travelers: DataFrame) -> DataFrame:
    return bookings_with_account(bookings, travelers).select(
        "booking_id", "traveler_id", "account_id", "booking_type", "booking_date", "travel_date", "amount",
        "is_out_of_policy", "is_cancelled", "destination_region",
        days_between(F.col("booking_date"), F.col("travel_date")).alias("lead_time_days"),
    )


def stg_service_contracts(contracts: DataFrame) -> DataFrame:
    return contracts.select(
        "contract_id", "account_id", "product", "start_date", "end_date", "contract_value", "is_active",
        month_boundaries(F.col("start_date"), F.col("end_date")).alias("contract_months"),
    )


def stg_support_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.select(
        "ticket_id", "account_id", "created_date", "resolved_date", "severity", "category", "resolution_hours",
        lookup(F.col("severity"), SEVERITY_COST, 0).alias("cost_proxy"),
    )


def stg_traveler_profiles(travelers: DataFrame) -> DataFrame:
    return travelers.select("traveler_id", "account_id", "role", "travel_tier")


def stg_churn_predictions(predictions: DataFrame, as_of: date) -> DataFrame:
    return predictions.select(
        "account_id", "churn_risk_score", "survival_prob_30d", "survival_prob_90d", "survival_prob_180d",
        "survival_prob_365d", "expected_lifetime_days", day(as_of).alias("prediction_date"),
    )


def stg_cross_sell_recommendations(recommendations: DataFrame, as_of: date) -> DataFrame:
    return recommendations.select(
        "account_id", "top_1_product", "top_1_score", "top_2_product", "top_2_score", "num_products_current",
        day(as_of).alias("prediction_date"),
    )


def stage_all(tables: dict[str, DataFrame], as_of: date) -> dict[str, DataFrame]:
    """Every staging view whose raw table is present."""
    out = {
        "accounts": stg_corporate_accounts(tables["accounts"], as_of),
        "bookings": stg_bookings(tables["bookings"], tables["travelers"]),
        "contracts": stg_service_contracts(tables["contracts"]),
        "tickets": stg_support_tickets(tables["tickets"]),
        "travelers": stg_traveler_profiles(tables["travelers"]),
    }
    if "churn_predictions" in tables:
        out["churn_predictions"] = stg_churn_predictions(tables["churn_predictions"], as_of)
    if "recommendations" in tables:
        out["recommendations"] = stg_cross_sell_recommendations(tables["recommendations"], as_of)
    return out
