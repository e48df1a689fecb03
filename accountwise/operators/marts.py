"""Star schema: dimensions, facts and the customer-value mart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.config import (
    CHURN_BIAS_BY_INDUSTRY, CHURN_BIAS_BY_TIER, OPEN_END, PRODUCT_CATEGORY, PRODUCT_MARGIN, SEVERE,
    UPSELL_BIAS_BY_INDUSTRY_PRODUCT, UPSELL_BIAS_BY_TIER,
)
from accountwise.functions.columns import blank_to, cents, clamp01, day, lookup, money, rate, risk_level, zero_if_null


def dim_accounts(stg_accounts: DataFrame) -> DataFrame:
    return stg_accounts.select(
        "account_id", "company_name",
        blank_to(F.col("industry"), "Not Specified").alias("industry"),
        blank_to(F.col("region"), "Not Specified").alias("region"),
        blank_to(F.col("tier"), "Uncategorized").alias("tier"),
        "onboarding_date",
        F.coalesce("churn_date", day(OPEN_END)).alias("churn_date"),
        "is_churned", "tenure_days",
        F.col("annual_contract_value").alias("base_acv"),
    )


def dim_products(stg_contracts: DataFrame, stg_recommendations: DataFrame | None = None) -> DataFrame:
    """Products seen in contracts or recommendations; one scan of each, deduplicated map-side."""
    names = stg_contracts.select(F.col("product").alias("product_name"))
    if stg_recommendations is not None:
        names = names.union(
            stg_recommendations.select(F.explode(F.array("top_1_product", "top_2_product")).alias("product_name"))
        )
    names = names.where(F.col("product_name").isNotNull()).distinct()
    name = F.col("product_name")
    return names.select(
        F.md5(name).alias("product_id"), "product_name",
        lookup(name, PRODUCT_CATEGORY, "Other Service").alias("product_category"),
        lookup(name, PRODUCT_MARGIN, 0.50).alias("estimated_gross_margin_pct"),
    )


def dim_date(spark: SparkSession, first: date = date(2020, 1, 1), last: date = date(2029, 12, 31)) -> DataFrame:
    d = F.col("date_day")
    days = spark.range(1).select(F.explode(F.sequence(day(first), day(last))).alias("date_day"))
    dow = F.dayofweek(d) - 1
    return days.select(
        "date_day", F.year(d).alias("year"), F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"), F.quarter(d).alias("quarter"), dow.alias("day_of_week"),
        dow.isin(0, 6).alias("is_weekend"), F.dayofmonth(d).alias("day_of_month"),
        F.trunc(d, "month").alias("first_day_of_month"), F.trunc(d, "quarter").alias("first_day_of_quarter"),
        F.trunc(d, "year").alias("first_day_of_year"),
    )


def dim_travelers(stg_travelers: DataFrame) -> DataFrame:
    return stg_travelers.select(
        "traveler_id", "account_id",
        blank_to(F.col("role"), "Unspecified Role").alias("role"),
        blank_to(F.col("travel_tier"), "Standard").alias("travel_tier"),
    )


def fact_bookings(stg_bookings: DataFrame) -> DataFrame:
    return stg_bookings.select(
        "booking_id", "account_id", "booking_date", "travel_date",
        zero_if_null(F.col("amount")).alias("transaction_amount"), "is_out_of_policy",
        zero_if_null(F.col("lead_time_days")).alias("lead_time_days"),
    )


def fact_service_contracts(stg_contracts: DataFrame) -> DataFrame:
    return stg_contracts.select(
        "contract_id", "account_id", "start_date", "end_date", F.col("product").alias("service_product"),
        zero_if_null(F.col("contract_months")).alias("contract_months"),
        zero_if_null(F.col("contract_value")).alias("contract_value"), "is_active",
    )


def fact_support_tickets(stg_tickets: DataFrame) -> DataFrame:
    return stg_tickets.select(
        "ticket_id", "account_id", "created_date",
        F.coalesce("resolved_date", F.lit(OPEN_END).cast(stg_tickets.schema["resolved_date"].dataType))
        .alias("resolved_date"),
        "severity", "category", zero_if_null(F.col("resolution_hours")).alias("resolution_hours"), "cost_proxy",
        # CASE, not a cast: an unknown severity counts as 0
        F.when(F.col("severity").isin(*SEVERE), 1).otherwise(0).alias("is_high_severity"),
    )


def renewal_dates(stg_contracts: DataFrame) -> DataFrame:
    return stg_contracts.groupBy("account_id").agg(F.max("end_date").alias("expected_renewal_date"))


def fact_ml_churn(
    stg_churn: DataFrame, dim_accounts: DataFrame, stg_contracts: DataFrame, stg_tickets: DataFrame
) -> DataFrame:
    """Calibrated churn risk. The level is taken before the score is clamped."""
    ticket_counts = stg_tickets.groupBy("account_id").agg(F.count(F.lit(1)).alias("support_ticket_count"))
    profile = dim_accounts.select("account_id", "industry", "tier")
    adjusted = (
        F.coalesce("churn_risk_score", F.lit(0.0))
        + lookup(F.col("industry"), CHURN_BIAS_BY_INDUSTRY, 0.0)
        + lookup(F.col("tier"), CHURN_BIAS_BY_TIER, 0.0)
    )
    joined = (
        stg_churn.join(profile, "account_id", "left")
        .join(renewal_dates(stg_contracts), "account_id", "left")
        .join(ticket_counts, "account_id", "left")
        .withColumn("adjusted", adjusted)
    )
    return joined.select(
        "account_id", "prediction_date", clamp01(F.col("adjusted")).alias("churn_risk_score"),
        risk_level(F.col("adjusted")).alias("risk_level"),
        *[
            F.coalesce(f"survival_prob_{h}d", F.lit(1.0)).alias(f"survival_prob_{h}d")
            for h in (30, 90, 180, 365)
        ],
        F.coalesce("expected_lifetime_days", F.lit(3650.0)).alias("expected_lifetime_days"),
        "expected_renewal_date", zero_if_null(F.col("support_ticket_count")).alias("support_ticket_count"),
        "industry", "tier",
    )


def fact_ml_cross_sell(
    stg_recommendations: DataFrame, dim_accounts: DataFrame, stg_contracts: DataFrame
) -> DataFrame:
    """One row per account and recommendation rank. Unpivoted in one scan, NULL products dropped."""
    offers = F.array(*[
        F.struct(
            F.lit(r).alias("recommendation_rank"), F.col(f"top_{r}_product").alias("recommended_product"),
            F.col(f"top_{r}_score").alias("score"),
        )
        for r in (1, 2)
    ])
    long = (
        stg_recommendations.select("account_id", "prediction_date", "num_products_current", F.inline(offers))
        .where(F.col("recommended_product").isNotNull())
    )
    by_product = F.lit(0.0)
    for (industry, product), bias in UPSELL_BIAS_BY_INDUSTRY_PRODUCT.items():
        by_product = F.when(
            (F.col("industry") == industry) & (F.col("recommended_product") == product), bias
        ).otherwise(by_product)
    adjusted = F.col("score") + by_product + lookup(F.col("tier"), UPSELL_BIAS_BY_TIER, 0.0)
    return (
        long.join(dim_accounts.select("account_id", "industry", "tier", "base_acv"), "account_id", "left")
        .join(renewal_dates(stg_contracts), "account_id", "left")
        .select(
            "account_id", "prediction_date", "recommendation_rank", "recommended_product",
            clamp01(adjusted).alias("probability_score"), "num_products_current", "industry", "tier",
            "base_acv", "expected_renewal_date",
        )
    )


def mart_clv_analytics(
    stg_accounts: DataFrame, stg_bookings: DataFrame, stg_tickets: DataFrame, stg_contracts: DataFrame
) -> DataFrame:
    """One wide row per account. Each event table is aggregated before the joins, so nothing fans out
    and a hot account is combined map-side before it is shuffled."""
    spent = money(F.sum(cents(F.col("amount"))))
    # NULL account ids match no account: dropping them early saves the shuffle of one hot NULL group
    known = F.col("account_id").isNotNull()
    booked = stg_bookings.where(known).groupBy("account_id").agg(
        F.count("booking_id").alias("total_bookings"),
        spent.alias("total_booking_amount"),
        rate(spent, F.count("amount")).alias("avg_booking_amount"),
        F.count_if("is_out_of_policy").alias("out_of_policy_bookings"),
    )
    asked = stg_tickets.where(known).groupBy("account_id").agg(
        F.count("ticket_id").alias("total_support_tickets"),
        F.count_if(F.col("severity").isin(*SEVERE)).alias("high_severity_tickets"),
        F.sum("cost_proxy").alias("total_support_cost_proxy"),
    )
    signed = stg_contracts.where(F.col("is_active") & known).groupBy("account_id").agg(
        money(F.sum(cents(F.col("contract_value")))).alias("active_contract_value"),
        F.count("contract_id").alias("active_contracts"),
    )
    joined = (
        stg_accounts.join(booked, "account_id", "left")
        .join(asked, "account_id", "left")
        .join(signed, "account_id", "left")
    )
    filled = [
        "total_bookings", "total_booking_amount", "avg_booking_amount", "out_of_policy_bookings",
        "total_support_tickets", "high_severity_tickets", "total_support_cost_proxy",
        "active_contract_value", "active_contracts",
    ]
    run_rate = F.when(
        F.col("tenure_days") > 0, F.col("total_booking_amount") / F.col("tenure_days") * 365
    ).otherwise(0.0)
    return (
        joined.na.fill(0, filled)
        .select(
            "account_id", "company_name", "industry", "region", "tier", "onboarding_date", "is_churned",
            "churn_date", F.col("annual_contract_value").alias("base_acv"), "tenure_days", *filled,
            run_rate.alias("annualized_booking_run_rate"),
            F.coalesce(rate(F.col("out_of_policy_bookings"), F.col("total_bookings")), F.lit(0.0))
            .alias("out_of_policy_rate"),
        )
    )
