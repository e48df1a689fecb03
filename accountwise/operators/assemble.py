"""The account feature matrix and its statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountwise.config import MODEL_EXCLUDED, PRODUCT_FLAGS, SENSITIVE_NAME_PARTS, TIER_RANK, Params
from accountwise.functions.columns import day, days_between, lookup, numeric_columns
from accountwise.operators.bookings import booking_features
from accountwise.operators.labels import value_ahead
from accountwise.operators.ranking import melt
from accountwise.operators.service import service
from accountwise.operators.support import support


def assemble(
    accounts: DataFrame,
    groups: list[DataFrame],
    labels: DataFrame | None,
    p: Params,
    feature_ts: datetime,
    null_recency: bool = False,
) -> DataFrame:
    """Left-join the feature groups to the accounts; numeric NULLs become 0, the rest stays as it is.

    Every side has one row per account, so the joins cannot fan out or skew. ``null_recency`` keeps
    "never booked" apart from "booked on the cutoff day". Without ``labels`` the groups bring what the label is made of.
    """
    base = accounts.select(
        "account_id", "tier", "region", "industry", "is_churned",
        F.col("annual_contract_value").cast("double").alias("annual_contract_value"), "onboarding_date",
        F.greatest(F.lit(0), days_between(F.col("onboarding_date"), day(p.cutoff))).alias("tenure_days"),
        lookup(F.col("tier"), TIER_RANK, None).alias("tier_rank"),
        F.col("onboarding_date").isNotNull().alias("_dated"),
    )
    # greatest() skips NULL: an unknown onboarding date is a NULL tenure first, 0 after the fill
    base = base.withColumn("tenure_days", F.when(F.col("_dated"), F.col("tenure_days"))).drop("_dated")
    for group in groups:
        base = base.join(group, "account_id", "left")
    if labels is None:
        ahead = ("revenue_ahead", "active_cents", "cost_ahead")
        base = base.withColumn("clv_12m", value_ahead(*map(F.col, ahead)).cast("double")).drop(*ahead)
    else:
        base = base.join(labels.select("account_id", F.col("clv_12m").cast("double")), "account_id", "left")
    keep_null = {"account_id"} | ({"days_since_last_booking"} if null_recency else set())
    return base.na.fill(0, numeric_columns(base, keep_null)).withColumn(
        "feature_timestamp", F.lit(feature_ts).cast("timestamp_ntz")
    )


def account_features(
    tables: dict[str, DataFrame], p: Params, feature_ts: datetime, labels: DataFrame | None = None
) -> DataFrame:
    """The whole matrix. ``tables['bookings']`` carry ``account_id``.

    Without given labels, each table's one scan also adds up the label period: no table is read twice.
    """
    own = labels is None
    groups = [
        booking_features(tables["bookings"], p, with_revenue=own), service(tables["contracts"], p, with_cents=own),
        support(tables["tickets"], p, with_cost=own),
    ]
    return assemble(tables["accounts"], groups, labels, p, feature_ts)


def is_sensitive(name: str) -> bool:
    return any(part in name.lower() for part in SENSITIVE_NAME_PARTS)


def feature_statistics(features: DataFrame, redact: bool = True) -> DataFrame:
    """mean / std / min / max per numeric column in one pass over the long form.

    With ``redact``, money columns are left out and only their number is reported.
    """
    numeric = numeric_columns(features, {"account_id"})
    shown = [c for c in numeric if not (redact and is_sensitive(c))]
    long = melt(features, [], shown, "feature", "value")
    return long.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ).withColumn("redacted_columns", F.lit(len(numeric) - len(shown)))


def model_inputs(features: DataFrame, drop_product_flags: bool = False) -> list[str]:
    """Numeric columns that are neither ids, targets nor metadata (and, for cross-sell, no adoption flags)."""
    skip = set(MODEL_EXCLUDED) | (set(PRODUCT_FLAGS.values()) if drop_product_flags else set())
    return numeric_columns(features, skip)


def model_input_table(features: DataFrame) -> DataFrame:
    """Which columns each model may use, as a table (from the schema alone)."""
    clv, cross = set(model_inputs(features)), set(model_inputs(features, True))
    rows = [
        (f.name, isinstance(f.dataType, T.NumericType), f.name in clv, f.name in cross)
        for f in features.schema if f.name != "account_id"
    ]
    return features.sparkSession.createDataFrame(
        rows, "column string, is_numeric boolean, clv_input boolean, cross_sell_input boolean"
    )
