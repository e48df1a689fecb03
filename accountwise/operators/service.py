"""Service-adoption features per account, from contracts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwise.config import PRODUCT_FLAGS, PRODUCTS, Params
from accountwise.functions.columns import cents, day, money, rate

RENEWAL_GAP_DAYS = 90


def active_at(p: Params, strict: bool = False) -> Column:
    c = day(p.cutoff)
    if strict:
        return (F.col("start_date") < c) & (F.col("end_date") > c)
    return (F.col("start_date") <= c) & (F.col("end_date") >= c)


def _per_product_day(contracts: DataFrame, p: Params) -> DataFrame:
    """One row per (account, product, start day): the raw rows are combined map-side, so even an account
    that owns a third of all contracts is spread over its start days."""
    active = active_at(p)
    soon = F.col("end_date") >= F.date_sub("start_date", RENEWAL_GAP_DAYS)
    return (
        contracts.where(F.col("account_id").isNotNull())
        .groupBy("account_id", "product", "start_date")
        .agg(
            F.count_if(active).alias("n_active"),
            F.sum(F.when(active, cents(F.col("contract_value")))).alias("active_value"),
            # same-day contracts follow each other by id: every one but the last can be renewed that day
            F.count_if(soon).alias("n_soon"),
            F.max_by("end_date", "contract_id").alias("last_end"),
        )
    )


def _renewals_on_day() -> Column:
    last_is_soon = F.coalesce(F.col("last_end") >= F.date_sub("start_date", RENEWAL_GAP_DAYS), F.lit(False))
    # rows without a start date sort last and never count
    return F.when(F.col("start_date").isNotNull(), F.col("n_soon") - last_is_soon.cast("int")).otherwise(0)


def service(contracts: DataFrame, p: Params, before_cutoff_only: bool = False, with_cents: bool = False) -> DataFrame:
    """Active products, diversity, value, renewals and adoption flags.

    Renewals look at all contracts by default, also those after the cutoff; ``before_cutoff_only`` closes
    that leak. Flags and counts are NULL for accounts without an active contract (0 after assembly).
    """
    if before_cutoff_only:
        contracts = contracts.where(F.col("start_date") < day(p.cutoff))
    # window partitions hold the start days of one (account, product): bounded by the calendar
    seq = Window.partitionBy("account_id", "product").orderBy(F.col("start_date").asc_nulls_last())
    previous = F.lag("last_end").over(seq)
    days = _per_product_day(contracts, p).withColumn(
        "n_renewed",
        _renewals_on_day()
        + F.coalesce((F.datediff("start_date", previous) <= RENEWAL_GAP_DAYS).cast("int"), F.lit(0)),
    )
    products = days.groupBy("account_id", "product").agg(
        F.sum("n_active").alias("n_active"), F.sum("active_value").alias("active_value"),
        F.sum("n_renewed").alias("n_renewed"),
    )
    # a NULL product is a missing key: it counts in no product measure
    named = F.col("product").isNotNull()
    total = F.sum(F.when(named, F.col("n_active"))).over(Window.partitionBy("account_id"))
    share = rate(F.col("n_active"), F.col("total_active"))
    entropy_term = F.when(named & (F.col("n_active") > 0), share * F.log2(share + F.lit(1e-10)))
    flags = [
        F.max(F.when((F.col("product") == name) & (F.col("n_active") > 0), 1)).alias(flag)
        for name, flag in PRODUCT_FLAGS.items()
    ]
    return (
        products.withColumn("total_active", total)
        .groupBy("account_id")
        .agg(
            F.nullif(F.count_if((F.col("n_active") > 0) & named), F.lit(0)).alias("num_active_products"),
            (-F.sum(entropy_term) / F.lit(math.log2(len(PRODUCTS)))).alias("product_diversity_score"),
            money(F.sum("active_value")).alias("active_contract_value"),
            F.sum(F.when(named, F.col("n_renewed"))).alias("contract_renewal_count"),
            *flags, *([F.sum("active_value").alias("active_cents")] if with_cents else []),
        )
    )


def service_strict(accounts: DataFrame, contracts: DataFrame, p: Params) -> DataFrame:
    """Variant with strict bounds that counts contract rows instead of distinct products."""
    per_account = (
        contracts.where(active_at(p, strict=True))
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("num_active_products"),
            money(F.sum(cents(F.col("contract_value")))).alias("active_contract_value"),
            *[
                F.max(F.when(F.col("product") == name, 1).otherwise(0)).alias(flag)
                for name, flag in PRODUCT_FLAGS.items()
            ],
        )
    )
    names = [c for c in per_account.columns if c != "account_id"]
    return accounts.select("account_id").join(per_account, "account_id", "left").na.fill(0, names)
