"""Executive measures over the marts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountwise.functions.columns import day, rate
from accountwise.operators.ranking import exact_quantiles, melt, top_n

HIT_SCORE = 0.80


def _active(contracts: DataFrame) -> DataFrame:
    return contracts.where(F.col("is_active"))


def _arr_by_account(contracts: DataFrame) -> DataFrame:
    return _active(contracts).groupBy("account_id").agg(F.sum("contract_value").alias("arr"))


def total_active_arr(contracts: DataFrame) -> DataFrame:
    return _active(contracts).agg(F.sum("contract_value").alias("total_active_arr"))


def predicted_churn_arr(contracts: DataFrame, churn: DataFrame) -> DataFrame:
    high = churn.where(F.col("risk_level") == "High").select("account_id")
    return _active(contracts).join(high, "account_id", "left_semi").agg(
        F.coalesce(F.sum("contract_value"), F.lit(0)).alias("predicted_churn_arr")
    )


def booking_run_rate(bookings: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Travel volume of the trailing days, the reporting day included."""
    recent = (F.col("booking_date") > day(as_of - timedelta(days=days))) & (F.col("booking_date") <= day(as_of))
    return bookings.where(recent).agg(
        F.coalesce(F.sum("transaction_amount"), F.lit(0)).alias("booking_run_rate"),
        F.count(F.lit(1)).alias("bookings"),
    )


def churn_arr_decomposition(contracts: DataFrame, churn: DataFrame, accounts: DataFrame) -> DataFrame:
    """Rollup region > tier > industry. Contracts are reduced to one row per account before the joins."""
    high = churn.where(F.col("risk_level") == "High").select("account_id")
    rows = (
        _arr_by_account(contracts).join(high, "account_id", "left_semi")
        .join(accounts.select("account_id", "region", "tier", "industry"), "account_id")
    )
    return rows.rollup("region", "tier", "industry").agg(
        F.sum("arr").alias("churn_arr"), F.count(F.lit(1)).alias("accounts"), F.grouping_id().alias("level")
    )


def arr_and_pipeline_by_month(contracts: DataFrame, cross_sell: DataFrame, first: date, last: date) -> DataFrame:
    """Active ARR on the first day of each month next to the weighted upsell pipeline renewing that month.

    Each contract adds its value in its first month and takes it away after its last: two rows instead of
    one per month, then a running sum over the calendar (one row per month).
    """
    month = lambda c: F.trunc(c, "month")
    begins = F.when(month("start_date") == F.col("start_date"), F.col("start_date")).otherwise(
        F.add_months(month("start_date"), 1)
    )
    moves = F.array(
        F.struct(begins.alias("month"), F.col("contract_value").alias("move")),
        F.struct(F.add_months(month("end_date"), 1).alias("month"), (-F.col("contract_value")).alias("move")),
    )
    # a contract that covers no month start adds and removes in the same month
    valid = F.col("start_date").isNotNull() & F.col("end_date").isNotNull() & (F.col("end_date") >= F.col("start_date"))
    steps = contracts.where(valid).select(F.inline(moves)).groupBy("month").agg(F.sum("move").alias("move"))
    running = Window.partitionBy(F.lit(0)).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    calendar = contracts.sparkSession.range(1).select(
        F.explode(F.sequence(day(first), day(last), F.expr("interval 1 month"))).alias("month")
    )
    every = calendar.select("month", F.lit(0).alias("move"), F.lit(True).alias("shown")).unionByName(
        steps.select("month", "move", F.lit(False).alias("shown"))
    )
    arr = (
        every.groupBy("month").agg(F.sum("move").alias("move"), F.max("shown").alias("shown"))
        .withColumn("active_arr", F.sum("move").over(running)).where("shown").select("month", "active_arr")
    )
    # exact decimals: the sum must not depend on the order of the tasks
    weighted = (F.col("probability_score") * F.col("base_acv").cast("double")).cast("decimal(24,8)")
    pipeline = cross_sell.groupBy(month("expected_renewal_date").alias("month")).agg(
        F.sum(weighted).cast("double").alias("upsell_pipeline")
    )
    return arr.join(pipeline, "month", "left").na.fill(0.0, ["upsell_pipeline"])


def top_churn_risks(churn: DataFrame, n: int = 10) -> DataFrame:
    return top_n(churn, [F.desc("churn_risk_score"), F.asc("account_id")], n).select(
        "account_id", "churn_risk_score", "risk_level", "industry", "tier"
    )


def support_kpis(tickets: DataFrame, churn: DataFrame) -> DataFrame:
    high = churn.agg(F.count_if(F.col("risk_level") == "High")).scalar()
    return tickets.agg(
        F.sum("cost_proxy").alias("total_support_cost"),
        rate(F.sum("resolution_hours"), F.count("resolution_hours")).alias("avg_resolution_hours"),
    ).withColumn("high_risk_accounts", high)


def resolution_risk_quadrants(tickets: DataFrame, churn: DataFrame, accounts: DataFrame, cuts=None) -> DataFrame:
    """Average resolution time against churn score per account, split at the medians."""
    slow = tickets.groupBy("account_id").agg(
        rate(F.sum("resolution_hours"), F.count("resolution_hours")).alias("avg_resolution_hours")
    )
    rows = (
        slow.join(churn.select("account_id", "churn_risk_score", "risk_level"), "account_id")
        .join(accounts.select("account_id", "base_acv"), "account_id", "left")
    )
    axes = ("avg_resolution_hours", "churn_risk_score")
    medians = exact_quantiles(melt(rows, [], axes, "axis", "value"), ["axis"], "value", {"median": 0.5}, cuts)
    mid = {c: medians.where(F.col("axis") == c).select("median").scalar() for c in axes}
    is_slow = F.col("avg_resolution_hours") > mid["avg_resolution_hours"]
    risky = F.col("churn_risk_score") > mid["churn_risk_score"]
    return rows.withColumn(
        "quadrant",
        F.when(is_slow & risky, "slow support, high risk").when(is_slow, "slow support, low risk")
        .when(risky, "fast support, high risk").otherwise("fast support, low risk"),
    )


def churn_influencers(churn: DataFrame, accounts: DataFrame, tickets: DataFrame) -> DataFrame:
    """Mean score of the accounts with a factor value against the mean of all others."""
    scored = churn.select("account_id", "churn_risk_score")
    traits = accounts.select(
        "account_id",
        F.inline(F.array(*[
            F.struct(F.lit(f).alias("factor"), F.col(f).alias("value")) for f in ("industry", "region", "tier")
        ])),
    )
    severities = tickets.select("account_id", F.lit("severity").alias("factor"), F.col("severity").alias("value"))
    # exact decimals: sums do not depend on task order
    points = F.col("churn_risk_score").cast("decimal(20,10)")
    per_value = (
        traits.unionByName(severities.distinct()).where(F.col("value").isNotNull()).join(scored, "account_id")
        .groupBy("factor", "value").agg(
            F.count("churn_risk_score").alias("accounts"), F.sum(points).alias("points")
        )
    )
    all_points = scored.agg(F.sum(points)).scalar()
    all_accounts = scored.agg(F.count("churn_risk_score")).scalar()
    mean_with = rate(F.col("points"), F.col("accounts"))
    mean_rest = rate(all_points - F.col("points"), all_accounts - F.col("accounts"))
    return per_value.select(
        "factor", "value", "accounts", mean_with.alias("mean_score"), mean_rest.alias("mean_score_rest"),
        (mean_with - mean_rest).alias("lift"),
    )


def weighted_pipeline(cross_sell: DataFrame, products: DataFrame) -> DataFrame:
    margin = products.select(F.col("product_name").alias("recommended_product"), "estimated_gross_margin_pct")
    part = (F.col("probability_score") * F.col("estimated_gross_margin_pct")).cast("decimal(20,10)")
    # scores are summed per product first, so the join moves one row per product
    return (
        cross_sell.groupBy("recommended_product", "probability_score").agg(F.count(F.lit(1)).alias("n"))
        .join(margin, "recommended_product").agg(F.sum(part * F.col("n")).alias("weighted_pipeline"))
    )


def product_mix_by_industry(cross_sell: DataFrame) -> DataFrame:
    counts = cross_sell.groupBy("industry", "recommended_product").agg(F.count(F.lit(1)).alias("recommendations"))
    total = F.sum("recommendations").over(Window.partitionBy("industry"))  # one row per product
    return counts.withColumn("share", rate(F.col("recommendations"), total))


def hit_list(cross_sell: DataFrame, accounts: DataFrame, contracts: DataFrame, score: float = HIT_SCORE) -> DataFrame:
    picks = cross_sell.where((F.col("recommendation_rank") == 1) & (F.col("probability_score") > score))
    return (
        picks.select("account_id", "recommended_product", "probability_score")
        .join(accounts.select("account_id", "company_name"), "account_id", "left")
        .join(_arr_by_account(contracts), "account_id", "left")
        .na.fill(0, ["arr"]).withColumnRenamed("arr", "current_arr")
    )


def _leakage(bookings: DataFrame) -> DataFrame:
    return bookings.where("is_out_of_policy")


def out_of_policy_spend(bookings: DataFrame) -> DataFrame:
    """Total leakage and the worst account (ties: smallest id)."""
    per_account = _leakage(bookings).groupBy("account_id").agg(F.sum("transaction_amount").alias("spend"))
    worst = top_n(
        per_account.where(F.col("account_id").isNotNull()), [F.desc("spend"), F.asc("account_id")], 1
    ).select(F.col("account_id").alias("worst_account"), F.col("spend").alias("worst_account_spend"))
    total = per_account.agg(F.sum("spend")).scalar()
    return worst.withColumn("out_of_policy_spend", total)


def out_of_policy_ribbon(bookings: DataFrame, accounts: DataFrame) -> DataFrame:
    """Monthly leakage by industry, its rank within the month and the change of rank."""
    by_account = _leakage(bookings).where(F.col("account_id").isNotNull()).groupBy(
        "account_id", F.trunc("booking_date", "month").alias("month")
    ).agg(F.sum("transaction_amount").alias("spend"))
    cells = by_account.join(accounts.select("account_id", "industry"), "account_id").groupBy("month", "industry").agg(
        F.sum("spend").alias("spend")
    )
    ranked = cells.withColumn("rank", F.rank().over(Window.partitionBy("month").orderBy(F.desc("spend"))))
    before = F.lag("rank").over(Window.partitionBy("industry").orderBy("month"))
    return ranked.withColumn("rank_change", before - F.col("rank"))


def out_of_policy_by_traveler_tier(stg_bookings: DataFrame, travelers: DataFrame) -> DataFrame:
    """Leakage is summed per traveler before the join: a hot traveler is one row there."""
    per_traveler = _leakage(stg_bookings).groupBy("traveler_id").agg(
        F.sum("amount").alias("spend"), F.count(F.lit(1)).alias("bookings")
    )
    tier = F.coalesce("travel_tier", F.lit("Unknown")).alias("travel_tier")
    return per_traveler.join(travelers.select("traveler_id", "travel_tier"), "traveler_id", "left").groupBy(tier).agg(
        F.sum("spend").alias("spend"), F.sum("bookings").alias("bookings")
    )


def ticket_timeline(tickets: DataFrame, account_id=None) -> DataFrame:
    rows = tickets if account_id is None else tickets.where(F.col("account_id") == account_id)
    return rows.groupBy("account_id", F.trunc("created_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("is_high_severity").alias("high_severity_tickets")
    )


def active_contract_list(contracts: DataFrame, account_id=None) -> DataFrame:
    rows = contracts if account_id is None else contracts.where(F.col("account_id") == account_id)
    return _active(rows).select(
        "account_id", "contract_id", "service_product", "start_date", "end_date", "contract_value"
    )


def policy_gauge(bookings: DataFrame, account_id=None) -> DataFrame:
    rows = bookings if account_id is None else bookings.where(F.col("account_id") == account_id)
    return rows.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("bookings"),
        (rate(F.count_if("is_out_of_policy"), F.count(F.lit(1))) * 100).alias("out_of_policy_percent"),
    )


def newly_high(current: DataFrame, previous: DataFrame, tier: str | None = None) -> DataFrame:
    """Accounts that are High now and were not in the previous snapshot."""
    now = current.where(F.col("risk_level") == "High")
    if tier:
        now = now.where(F.col("tier") == tier)
    was = previous.where(F.col("risk_level") == "High").select("account_id")
    return now.join(was, "account_id", "left_anti").select("account_id", "tier", "churn_risk_score")
