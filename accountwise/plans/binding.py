"""Binds the benchmark's star-schema parquet to the six customer tables (see FIXTURES.md).

Used by the registered queries, the tests and the benchmark; the operators know nothing about it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountwise.config import PRODUCT_FLAGS, PRODUCTS, Params
from accountwise.operators.bookings import rfm
from accountwise.operators.cross_sell import recommendations
from accountwise.operators.service import service
from accountwise.operators.staging import bookings_with_account

PARAMS = Params(cutoff=date(1999, 1, 16), as_of=date(2001, 8, 2))
FEATURE_TS = datetime(2001, 8, 2)


# known schemas: no job is spent on inferring them
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def t(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    orders = t("orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        "cast(o_orderdate as date) o_date",
    )
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    span = orders.groupBy("o_custkey").agg(F.min("o_date").alias("onboarding_date"), F.max("o_date").alias("last_d"))
    accounts = (
        t("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(span, F.col("o_custkey") == F.col("c_custkey"), "left")
        .selectExpr(
            "c_custkey account_id", "c_name company_name",
            "case c_mktsegment when 'AUTOMOBILE' then 'Retail' when 'MACHINERY' then 'Energy' "
            "when 'BUILDING' then 'Technology' when 'FURNITURE' then 'Financial Services' "
            "else 'Manufacturing' end industry",
            "r_name region",
            "case when c_acctbal >= 9000 then 'Platinum' when c_acctbal >= 7000 then 'Gold' "
            "when c_acctbal >= 3500 then 'Silver' when c_acctbal >= -900 then 'Bronze' else '' end tier",
            "onboarding_date", "last_d < date'2000-08-01' is_churned",
            "case when last_d < date'2000-08-01' then last_d end churn_date",
            "cast(greatest(c_acctbal, 0) as decimal(12,2)) annual_contract_value",
        )
    )
    travelers = orders.selectExpr(  # some travelers have no account
        "o_orderkey traveler_id", "case when o_orderkey % 50 <> 0 then o_custkey end account_id", "substr(o_orderpriority, 3) role",
        "case o_orderstatus when 'P' then 'VIP' when 'F' then 'Frequent' else '' end travel_tier",
    )
    bookings = (
        t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "l_orderkey * 10 + l_linenumber booking_id", "l_orderkey traveler_id",
            "case l_linenumber % 4 when 0 then 'Flight' when 1 then 'Hotel' when 2 then 'Rail' else 'Car' end booking_type",
            "cast(l_shipdate as date) booking_date", "date_add(cast(l_shipdate as date), l_linenumber * 7) travel_date",
            "cast(l_extendedprice as decimal(10,2)) amount", "l_discount >= 0.085 is_out_of_policy",
            "l_returnflag = 'R' is_cancelled", "r_name destination_region",
        )
    )
    contracts = orders.selectExpr(
        "o_orderkey contract_id", "o_custkey account_id",
        "case o_orderkey % 4 when 0 then 'Neo' when 1 then 'Egencia Analytics Studio' "
        "when 2 then 'Meetings & Events' else 'Travel Consulting' end product",
        "o_date start_date", "date_add(o_date, case when o_orderkey % 5 < 3 then 365 else 730 end) end_date",
        "cast(o_totalprice as decimal(12,2)) contract_value", "o_orderstatus <> 'F' is_active",
    )
    tickets = t("events").selectExpr(
        "event_id ticket_id", "user_id account_id",
        "date_add(date'1999-01-16', cast(30 * datediff(cast(ts as date), date'2024-01-16') + hour(ts) as int)) created_date",
        "case when event_id % 20 <> 0 then date_add(date'1999-01-16', cast(30 * datediff(cast(ts as date), "
        "date'2024-01-16') + hour(ts) + floor(value / 24) as int)) end resolved_date",
        "case event_type when 'error' then 'P1' when 'purchase' then 'P2' when 'click' then 'P3' "
        "when 'view' then 'P4' else 'P5' end severity",
        "case cast(get_json_object(props, '$.k') as int) % 4 when 0 then 'Billing' when 1 then 'Booking' "
        "when 2 then 'Technical' else 'Policy' end category",
        "cast(value as decimal(8,2)) resolution_hours",
    )
    return {
        "accounts": accounts, "travelers": travelers, "bookings": bookings, "contracts": contracts,
        "tickets": tickets,
    }


def with_owner(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same tables, bookings carrying their account (unknown travelers dropped)."""
    return {**tables, "bookings": bookings_with_account(tables["bookings"], tables["travelers"], "inner")}


def surrogate_churn(tables: dict[str, DataFrame], shift: int = 0) -> DataFrame:
    """A churn score rising with the days since the last booking; NULL for some accounts."""
    owned = with_owner(tables)
    recency = rfm(owned["bookings"], PARAMS).select("account_id", "days_since_last_booking")
    quiet = F.least(F.lit(365), F.coalesce("days_since_last_booking", F.lit(365)) + F.lit(shift))
    score = F.when(F.col("account_id") % 97 != 0, F.round(quiet.cast("double") / 365, 4))
    scored = tables["accounts"].select("account_id").join(recency, "account_id", "left").select(
        "account_id", score.alias("churn_risk_score")
    )
    s = F.col("churn_risk_score")
    return scored.select(
        "account_id",
        *[F.round(1 - s * h / 365, 4).alias(f"survival_prob_{h}d") for h in (30, 90, 180, 365)],
        s, (1 + s).alias("partial_hazard"), F.round(3650 * (1 - s), 3).alias("expected_lifetime_days"),
    )


def surrogate_probabilities(tables: dict[str, DataFrame]) -> DataFrame:
    flags = service(tables["contracts"], PARAMS).select("account_id", *PRODUCT_FLAGS.values())
    joined = tables["accounts"].select("account_id").join(flags, "account_id", "left")
    cols = []
    for i, product in enumerate(PRODUCTS):
        cols.append(((F.col("account_id") * 7 + i * 13) % 100 / F.lit(100.0)).alias(f"{product}_score"))
        cols.append(F.coalesce(F.col(PRODUCT_FLAGS[product]), F.lit(0)).alias(f"{product}_current"))
    return joined.select("account_id", *cols)


def surrogate_segments(features: DataFrame) -> DataFrame:
    """Cluster from the account id, -1 is noise; the segment comes from the labelling rules."""
    return features.withColumn("cluster", (F.col("account_id") % 5 - 1).cast("int"))


def with_predictions(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    probabilities = surrogate_probabilities(tables)
    return {
        **tables,
        "churn_predictions": surrogate_churn(tables),
        "probabilities": probabilities,
        "recommendations": recommendations(probabilities),
    }
