from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from accountwise.operators import alerts, bi, clv, cross_sell, lookups, marts, quality, segments, staging

AS_OF = date(2024, 1, 1)
ACCOUNT = ("account_id string, company_name string, industry string, region string, tier string, onboarding_date date, "
           "is_churned boolean, churn_date date, annual_contract_value decimal(12,2)")


def accounts(spark, rows):
    return spark.createDataFrame(
        [(a, "n", ind, "EMEA", tier, on, False, None, Decimal(1)) for a, ind, tier, on in rows], ACCOUNT
    )


def test_staging_rules(spark):
    df = staging.stg_corporate_accounts(accounts(spark, [("A", "x", "Unknown", date(2023, 12, 31))]), AS_OF)
    assert df.first()["tier_rank"] == 1 and df.first()["tenure_days"] == 1
    c = spark.createDataFrame(
        [("c", "A", "Neo", date(2021, 1, 31), date(2021, 2, 1), Decimal(1), True),
         ("d", "A", "Neo", date(2021, 1, 1), date(2021, 1, 31), Decimal(1), True)],
        "contract_id string, account_id string, product string, start_date date, end_date date, "
        "contract_value decimal(12,2), is_active boolean")
    assert [r["contract_months"] for r in staging.stg_service_contracts(c).orderBy("contract_id").collect()] == [1, 0]
    t = spark.createDataFrame([("t", "A", AS_OF, None, "P9", "x", None)],
                              "ticket_id string, account_id string, created_date date, resolved_date date, "
                              "severity string, category string, resolution_hours decimal(8,2)")
    stg = staging.stg_support_tickets(t)
    assert stg.first()["cost_proxy"] == 0
    fact = marts.fact_support_tickets(stg).first()
    assert fact["resolved_date"] == date(9999, 12, 31) and fact["resolution_hours"] == 0 and fact["is_high_severity"] == 0


def test_dim_date(spark):
    df = marts.dim_date(spark)
    days = {r["date_day"]: r for r in df.where(F.col("date_day").between(date(2024, 1, 6), date(2024, 1, 7))).collect()}
    assert days[date(2024, 1, 7)]["day_of_week"] == 0 and days[date(2024, 1, 6)]["day_of_week"] == 6
    assert all(r["is_weekend"] for r in days.values())
    assert df.count() == 3653 and df.agg(F.max("date_day")).first()[0] == date(2029, 12, 31)


CHURN = ("account_id string, churn_risk_score double, survival_prob_30d double, survival_prob_90d double, "
         "survival_prob_180d double, survival_prob_365d double, expected_lifetime_days double")
NO_CONTRACTS = ("contract_id string, account_id string, product string, start_date date, end_date date, "
                "contract_value decimal(12,2), is_active boolean, contract_months int")


def test_churn_calibration(spark):
    people = [("A", "Retail", "Bronze"), ("B", "Financial Services", "Platinum"), ("C", "Technology", "Gold")]
    dims = marts.dim_accounts(staging.stg_corporate_accounts(
        accounts(spark, [(a, i, t, AS_OF) for a, i, t in people]), AS_OF))
    pred = spark.createDataFrame([("A", 0.6, *[None] * 5), ("B", None, *[None] * 5), ("C", 0.3, *[None] * 5)], CHURN)
    empty_c = spark.createDataFrame([], NO_CONTRACTS)
    empty_t = spark.createDataFrame([], "ticket_id string, account_id string")
    got = {r["account_id"]: r for r in marts.fact_ml_churn(
        staging.stg_churn_predictions(pred, AS_OF), dims, empty_c, empty_t).collect()}
    assert got["A"]["risk_level"] == "High" and got["A"]["churn_risk_score"] == 1.0
    assert got["B"]["risk_level"] == "Low" and got["B"]["churn_risk_score"] == 0.0
    assert got["B"]["survival_prob_30d"] == 1 and got["B"]["expected_lifetime_days"] == 3650
    assert got["C"]["risk_level"] == "Low" and got["C"]["churn_risk_score"] == pytest.approx(0.15)


def test_cross_sell_bias_and_null_score(spark):
    dims = marts.dim_accounts(staging.stg_corporate_accounts(
        accounts(spark, [("A", "Technology", "Platinum", AS_OF), ("B", "x", "y", AS_OF)]), AS_OF))
    recs = spark.createDataFrame(
        [("A", "Egencia Analytics Studio", 0.9, None, 0.0, 1), ("B", "Neo", None, None, 0.0, 1)],
        "account_id string, top_1_product string, top_1_score double, top_2_product string, top_2_score double, "
        "num_products_current int")
    rows = marts.fact_ml_cross_sell(
        staging.stg_cross_sell_recommendations(recs, AS_OF), dims, spark.createDataFrame([], NO_CONTRACTS)).collect()
    assert {r["account_id"]: r["probability_score"] for r in rows} == {"A": 1.0, "B": None}


def matrix(spark, rows):
    cols = [c for p in cross_sell.PRODUCTS for c in (f"`{p}_score` double", f"`{p}_current` int")]
    return spark.createDataFrame(rows, "account_id string, " + ", ".join(cols))


def test_recommendations_ties_and_full_adoption(spark):
    df = matrix(spark, [("A", 0.4, 0, 0.4, 0, 0.9, 1, 0.2, 0), ("B", 0.4, 1, 0.4, 1, 0.9, 1, 0.2, 1)])
    got = {r["account_id"]: r for r in cross_sell.recommendations(df).collect()}
    assert (got["A"]["top_1_product"], got["A"]["top_2_product"]) == ("Neo", "Egencia Analytics Studio")
    assert got["A"]["num_products_current"] == 1
    assert tuple(got["B"])[1:] == (None, 0.0, None, 0.0, 4)


def test_percentile_and_metrics(spark):
    actual = spark.createDataFrame([(0.0,), (10.0,), (20.0,), (30.0,)], "clv_12m double")
    pred = spark.createDataFrame([("A", 20.0), ("B", -1.0), ("C", 99.0)], "account_id string, predicted_clv double")
    got = {r["account_id"]: r["clv_percentile"] for r in clv.clv_percentiles(pred, actual).collect()}
    assert got == {"A": 50.0, "B": 0.0, "C": 100.0}
    m = clv.regression_metrics(spark.createDataFrame([("m", 0.0, 10.0)], "model string, actual double, predicted double"))
    assert m.first()["mape"] == 1000.0 and m.first()["median_ae"] == 10.0


def test_cluster_rank_averages_ties_and_counts_noise(spark):
    rows = [(-1, 10.0), (0, 20.0), (1, 20.0)]
    cols = "cluster int, clv_12m double, booking_volume_trend double, cancellation_rate_90d double, " \
           "ticket_rate_per_month double, num_active_products double, total_spend_90d double, churn_rate double"
    df = spark.createDataFrame([(c, v, 0.0, 0.0, 0.0, 2.0, 0.0, 0.1) for c, v in rows], cols)
    got = {r["cluster"]: r for r in segments.label_clusters(df).collect()}
    assert got[0]["clv_rank"] == pytest.approx(2.5 / 3) and got[0]["segment"] == "Platinum Partners"
    assert got[-1]["segment"] == "Unassigned"


def test_arr_by_month_counts_month_starts(spark):
    c = spark.createDataFrame(
        [("A", date(2020, 1, 15), date(2020, 3, 1), Decimal(10)), ("A", date(2020, 2, 1), date(2020, 2, 20), Decimal(5)),
         ("A", date(2020, 2, 3), date(2020, 2, 20), Decimal(7))],
        "account_id string, start_date date, end_date date, contract_value decimal(12,2)")
    x = spark.createDataFrame([], "probability_score double, base_acv decimal(12,2), expected_renewal_date date")
    rows = bi.arr_and_pipeline_by_month(c, x, date(2020, 1, 1), date(2020, 5, 1)).orderBy("month").collect()
    assert [int(r["active_arr"]) for r in rows] == [0, 15, 10, 0, 0]


def test_gates(spark):
    df = spark.createDataFrame([(None,), ("x",)], "account_id string")
    assert not quality.null_keys({"accounts": df}).first()["ok"]
    row = quality.row_counts({"accounts": df}).first()
    assert row["observed"] == 2 and not row["ok"]
    checks = {r["table_name"]: r for r in quality.required_columns(spark, {"accounts": df}).collect()}
    assert checks["accounts"]["check_name"] == "missing_columns:is_churned,tier"
    assert checks["bookings"]["check_name"] == "missing_table"


def test_page_limits_and_alert_order(spark):
    with pytest.raises(ValueError):
        lookups.account_page(None, None, limit=101)
    churn = spark.createDataFrame(
        [(f"A{i}", 0.6 + 0.01 * (i % 3), "High", "x", "y", None, 0) for i in range(9)],
        "account_id string, churn_risk_score double, risk_level string, industry string, tier string, "
        "expected_renewal_date date, support_ticket_count bigint")
    assert [r["account_id"] for r in alerts.churn_alert(churn).collect()] == ["A2", "A5", "A8", "A1", "A4"]
