"""Forward customer-value labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwise.config import SEVERITY_COST, Params
from accountwise.functions.columns import cents, day, lookup
from accountwise.operators.service import active_at


def clv_labels(
    accounts: DataFrame, bookings: DataFrame, contracts: DataFrame, tickets: DataFrame, p: Params
) -> DataFrame:
    """Revenue of the next year plus active contract value minus support cost, floored at 0.

    ``bookings`` carry ``account_id``. Three aggregates, joined at one row per account.
    """
    start, end = day(p.cutoff), day(p.ahead(p.label_days))
    known = F.col("account_id").isNotNull()

    def ahead(c):
        return (F.col(c) >= start) & (F.col(c) < end)

    revenue = (
        bookings.where(ahead("booking_date") & ~F.col("is_cancelled") & known)
        .groupBy("account_id").agg(F.sum(cents(F.col("amount"))).alias("booking_revenue_12m"))
    )
    contracted = (
        contracts.where(active_at(p) & known)
        .groupBy("account_id").agg(F.sum(cents(F.col("contract_value"))).alias("contract_value_active"))
    )
    unit_cost = lookup(F.col("severity"), SEVERITY_COST, 0) * 100
    cost = (
        tickets.where(ahead("created_date") & known)
        .groupBy("account_id").agg(F.sum(unit_cost).alias("support_cost_12m"))
    )
    joined = accounts.select("account_id")
    for part in (revenue, contracted, cost):
        joined = joined.join(part, "account_id", "left")
    parts = ("booking_revenue_12m", "contract_value_active", "support_cost_12m")
    joined = joined.na.fill(0, list(parts))
    return joined.select(
        "account_id", *[as_money(F.col(c)).alias(c) for c in parts], value_ahead(*map(F.col, parts)).alias("clv_12m")
    )


def as_money(total_cents: Column) -> Column:
    return (total_cents.cast("decimal(20,0)") / 100).cast("decimal(20,2)")


def value_ahead(revenue: Column, contracted: Column, cost: Column) -> Column:
    """The label, from whole cents; NULL is 0."""
    revenue, contracted, cost = (F.coalesce(c, F.lit(0)) for c in (revenue, contracted, cost))
    return as_money(F.greatest(F.lit(0), revenue + contracted - cost))
