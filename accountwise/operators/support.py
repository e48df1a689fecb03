"""Support-health features per account, from tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountwise.config import SEVERE, SEVERITY_COST, Params
from accountwise.functions.columns import cents, day, lookup, money, rate

DAYS_PER_MONTH = 30.44


def support(tickets: DataFrame, p: Params, with_cost: bool = False) -> DataFrame:
    """Two-level aggregate: (account, category) rows are combined map-side and carry everything the
    account level needs, so tickets are shuffled once. ``with_cost`` adds ``cost_ahead``, the cents that the tickets of the
    label period cost; they enter no feature, but an account without other tickets then has a row."""
    created = F.col("created_date")
    if with_cost:
        past = created < day(p.cutoff)
        cost = lookup(F.col("severity"), SEVERITY_COST, 0) * 100
        tickets = tickets.where(created < day(p.ahead(p.label_days))).select(
            "account_id", "category", *[F.when(past, F.col(c)).alias(c) for c in ("created_date", "severity", "resolution_hours")],
            F.when(~past, cost).alias("cost"))
        more, until = [F.sum("cost").alias("cost_ahead")], F.lit(True)
    else:
        more, until = [], created < day(p.cutoff)
    severe = F.col("severity").isin(*SEVERE)
    hours = cents(F.col("resolution_hours"))  # hundredths of an hour
    cells = (
        tickets.where(until & F.col("account_id").isNotNull())
        .groupBy("account_id", "category")
        .agg(
            F.count(created).alias("n"), F.min(created).alias("first"), F.max(created).alias("last"),
            F.sum(hours).alias("hours"), F.count(hours).alias("timed"),
            F.count_if(severe).alias("n_severe"),
            F.sum(F.when(severe, hours)).alias("severe_hours"),
            F.count(F.when(severe, hours)).alias("severe_timed"),
            F.count_if(created >= day(p.back(90))).alias("n_recent"), *more,
        )
    )
    merged = cells.groupBy("account_id").agg(
        *[F.sum(c).alias(c) for c in
          ("n", "hours", "timed", "n_severe", "severe_hours", "severe_timed", "n_recent")],
        F.min("first").alias("first"), F.max("last").alias("last"),
        # a missing category is no category: shares are over categorised tickets
        F.max(F.when(F.col("category").isNotNull(), F.col("n"))).alias("top_category"),
        F.sum(F.when(F.col("category").isNotNull(), F.col("n"))).alias("categorised"),
        *[F.sum("cost_ahead").alias("cost_ahead") for _ in more],
    )
    months = F.greatest(F.lit(1.0), F.datediff("last", "first") / F.lit(DAYS_PER_MONTH))
    per_month = F.col("n") / months
    recent_per_month = F.nullif(F.col("n_recent"), F.lit(0)) / F.lit(3.0)
    return merged.select(
        "account_id",
        F.col("n").alias("total_ticket_count"),
        rate(money(F.col("hours")), F.col("timed")).alias("avg_resolution_hours"),
        per_month.alias("ticket_rate_per_month"),
        rate(F.col("n_severe"), F.col("n")).alias("p1_p2_escalation_ratio"),
        F.nullif(F.col("n_recent"), F.lit(0)).alias("ticket_count_90d"),
        (recent_per_month / F.greatest(per_month, F.lit(0.01))).alias("ticket_trend_ratio"),
        rate(money(F.col("severe_hours")), F.col("severe_timed")).alias("avg_severe_resolution_hours"),
        rate(F.col("top_category"), F.col("categorised")).alias("ticket_category_concentration"),
        *["cost_ahead" for _ in more],
    )
