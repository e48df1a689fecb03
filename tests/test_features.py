"""Hand-computed micro-fixtures for the features and labels."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from accountwise.operators import assemble, bookings, labels, service, support

BOOKING = ("account_id string, booking_id string, booking_date date, travel_date date, amount decimal(10,2), "
           "is_out_of_policy boolean, is_cancelled boolean, destination_region string")
CUTOFF = date(2023, 1, 1)


def book(account, day, amount=100, oop=False, cancelled=False, place="EMEA", lead=7):
    return (account, "b", day, day + timedelta(days=lead), Decimal(amount), oop, cancelled, place)


def before(days):
    return CUTOFF - timedelta(days=days)


def one(df, account="A"):
    return df.where(F.col("account_id") == account).first().asDict()


@pytest.fixture(scope="module")
def all_three(spark, params):
    def run(rows):
        df = spark.createDataFrame(rows, BOOKING)
        return df, bookings.booking_features(df, params)
    return run


def test_volume_trend_uses_dense_months(all_three):
    months = {date(2022, 1, 5): 2, date(2022, 3, 5): 4, date(2022, 8, 5): 6}
    _, f = all_three([book("A", d) for d, n in months.items() for _ in range(n)])
    assert one(f)["booking_volume_trend"] == pytest.approx(2.0)
    assert one(f)["spend_trend"] == pytest.approx(200.0)


def test_trend_needs_three_months(all_three):
    _, f = all_three([book("A", date(2022, 1, 5)), book("A", date(2022, 3, 5), 900)])
    assert one(f)["booking_volume_trend"] == 0.0 and one(f)["spend_trend"] == 0.0


def test_cancelled_months_count_for_volume_but_not_for_spend(all_three):
    rows = [book("A", date(2022, m, 5), 100 * m, cancelled=(m == 3)) for m in (1, 2, 3, 4)]
    got = one(all_three(rows)[1])
    assert got["booking_volume_trend"] == pytest.approx(0.0)
    # spend months are 1, 2, 4 at positions 0, 1, 2 with 100, 200, 400
    assert got["spend_trend"] == pytest.approx(150.0)


def test_spend_acceleration(all_three):
    rows = [book("A", before(10), 300), book("A", before(200), 100), book("B", before(10), 300)]
    f = all_three(rows)[1]
    assert one(f)["spend_acceleration"] == pytest.approx(200.0)
    assert one(f, "B")["spend_acceleration"] == 0.0


def test_window_bound_is_inclusive_and_cutoff_exclusive(all_three):
    got = one(all_three([book("A", before(30)), book("A", before(31)), book("A", CUTOFF)])[1])
    assert (got["booking_count_30d"], got["booking_count_90d"], got["total_booking_count"]) == (1, 2, 2)
    assert got["days_since_last_booking"] == 30


def test_rates_and_oop_trend(all_three):
    rows = [book("A", before(60), oop=True), book("A", before(61), cancelled=True),
            book("B", before(5), oop=True), book("B", before(60))]
    f = all_three(rows)[1]
    a, b = one(f), one(f, "B")
    assert a["cancellation_rate_90d"] == 0.5 and a["out_of_policy_rate_90d"] == 0.5
    assert a["out_of_policy_rate_30d"] is None and a["oop_trend"] is None  # 0 after assembly, not -0.5
    assert b["oop_trend"] == pytest.approx(0.5)


def test_combined_equals_separate_families(all_three, params):
    rows = [book(f"A{i % 7}", before(i % 400), i % 50, i % 3 == 0, i % 4 == 0, f"P{i % 5}", i % 9) for i in range(1, 900)]
    df, f = all_three(rows)
    for part in (bookings.rfm, bookings.trajectory, bookings.policy):
        alone = part(df, params)
        joined = f.select(alone.columns)
        assert sorted(map(str, alone.collect())) == sorted(map(str, joined.collect()))


CONTRACT = "contract_id string, account_id string, product string, start_date date, end_date date, contract_value decimal(12,2)"


def contracts(spark, rows):
    return spark.createDataFrame([(f"c{i}", *r, Decimal(10)) for i, r in enumerate(rows)], CONTRACT)


def test_renewals(spark, params):
    df = contracts(spark, [
        ("A", "Neo", date(2020, 1, 1), date(2020, 12, 31)), ("A", "Neo", date(2021, 2, 1), date(2022, 1, 31)),
        ("A", "Neo", date(2022, 8, 1), date(2023, 7, 31)),
        ("A", "Travel Consulting", date(2021, 1, 1), date(2021, 12, 31)),
        ("A", "Travel Consulting", date(2021, 6, 1), date(2022, 6, 1)),
    ])
    got = one(service.service(df, params))
    assert got["contract_renewal_count"] == 2
    assert got["has_neo"] == 1 and got["has_travel_consulting"] is None and got["num_active_products"] == 1
    assert one(service.service(df, params, before_cutoff_only=True))["contract_renewal_count"] == 2


def test_renewals_on_the_same_day_match_brute_force(spark, params):
    import random

    rng = random.Random(3)
    rows = []
    for i in range(600):
        start = date(2021, 1, 1) + timedelta(days=40 * rng.randrange(12))
        rows.append((f"A{rng.randrange(4)}", rng.choice(["Neo", "Travel Consulting"]), start,
                     start + timedelta(days=rng.randrange(-150, 200))))
    df = contracts(spark, rows)
    got = {r["account_id"]: r["contract_renewal_count"] for r in service.service(df, params).collect()}
    want: dict[str, int] = {}
    chains: dict[tuple, list] = {}
    for i, (a, prod, s, e) in enumerate(rows):
        chains.setdefault((a, prod), []).append((s, f"c{i}", e))
    for (a, _), chain in chains.items():
        chain.sort(key=lambda t: (t[0], t[1]))
        want[a] = want.get(a, 0) + sum((y[0] - x[2]).days <= 90 for x, y in zip(chain, chain[1:]))
    assert got == want


def test_product_diversity(spark, params):
    live = (date(2022, 1, 1), date(2024, 1, 1))
    df = contracts(spark, [("A", "Neo", *live), ("A", "Travel Consulting", *live), ("B", "Neo", *live)])
    f = service.service(df, params)
    assert one(f)["product_diversity_score"] == pytest.approx(0.5, abs=1e-9)
    assert one(f, "B")["product_diversity_score"] == pytest.approx(0.0, abs=1e-9)


TICKET = "ticket_id string, account_id string, created_date date, severity string, category string, resolution_hours decimal(8,2)"


def test_ticket_rates(spark, params):
    rows = [("t", "A", before(400), "P1", "Billing", Decimal(4))] + [
        ("t", "B", before(200 - d), "P3", c, Decimal(2)) for d, c in ((0, "x"), (30, "x"), (61, "y"))
    ]
    f = support.support(spark.createDataFrame(rows, TICKET), params)
    a, b = one(f), one(f, "B")
    assert a["ticket_rate_per_month"] == 1.0 and a["ticket_trend_ratio"] is None and a["p1_p2_escalation_ratio"] == 1.0
    assert b["ticket_rate_per_month"] == pytest.approx(1.4970, abs=1e-4)
    assert b["ticket_category_concentration"] == pytest.approx(2 / 3)


ACCOUNT = ("account_id string, tier string, region string, industry string, is_churned boolean, onboarding_date date, "
           "annual_contract_value decimal(12,2)")


def test_assembly_fills_only_numbers(spark, params):
    accounts = spark.createDataFrame([
        ("A", "Unknown", None, "x", None, date(2024, 1, 1), Decimal(5)), ("B", "Gold", "r", "x", True, None, None),
    ], ACCOUNT)
    tables = {
        "accounts": accounts, "bookings": spark.createDataFrame([], BOOKING),
        "contracts": spark.createDataFrame([], CONTRACT), "tickets": spark.createDataFrame([], TICKET),
    }
    m = assemble.account_features(tables, params, datetime(2024, 1, 1))
    a, b = one(m), one(m, "B")
    assert len(m.columns) == 49 and m.count() == 2
    assert a["tier_rank"] == 0 and a["tenure_days"] == 0 and a["days_since_last_booking"] == 0
    assert a["region"] is None and a["is_churned"] is None and b["tenure_days"] == 0 and b["tier_rank"] == 3
    kept = assemble.assemble(accounts, [bookings.rfm(tables["bookings"], params)],
                             accounts.selectExpr("account_id", "0 clv_12m"), params, datetime(2024, 1, 1), True)
    assert one(kept)["days_since_last_booking"] is None


def test_label_floor(spark, params):
    accounts = spark.createDataFrame([("A",), ("B",)], "account_id string")
    bk = spark.createDataFrame([book("A", CUTOFF), book("A", CUTOFF + timedelta(days=365)), book("B", CUTOFF, 40)], BOOKING)
    co = spark.createDataFrame(
        [("c", "A", "Neo", date(2022, 1, 1), CUTOFF, Decimal(50))], CONTRACT)
    tk = spark.createDataFrame([("t", "A", CUTOFF, "P1", "x", Decimal(1)), ("t", "B", CUTOFF, "P9", "x", Decimal(1))], TICKET)
    f = labels.clv_labels(accounts, bk, co, tk, params)
    a, b = one(f), one(f, "B")
    assert (a["booking_revenue_12m"], a["contract_value_active"], a["support_cost_12m"], a["clv_12m"]) == (100, 50, 2000, 0)
    assert b["clv_12m"] == 40


def test_statistics_hide_money(spark):
    df = spark.createDataFrame([("A", 1.0, 5.0), ("B", 3.0, 6.0)], "account_id string, visits double, total_spend double")
    rows = assemble.feature_statistics(df).collect()
    assert [r["feature"] for r in rows] == ["visits"] and rows[0]["redacted_columns"] == 1
    assert rows[0]["std"] == pytest.approx(2**0.5)


def test_the_matrix_reads_each_table_once_and_has_the_separate_labels(spark):
    from accountwise.operators import assemble, labels
    from accountwise.plans import binding

    tables = binding.with_owner(binding.load(spark, "/root/testdata/sf0.001"))
    joint = assemble.account_features(tables, binding.PARAMS, binding.FEATURE_TS)
    own = labels.clv_labels(tables["accounts"], tables["bookings"], tables["contracts"], tables["tickets"], binding.PARAMS)
    apart = assemble.account_features(tables, binding.PARAMS, binding.FEATURE_TS, own)
    plan = joint._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem.parquet") <= 1 and joint.exceptAll(apart.select(joint.columns)).isEmpty()
    scans = lambda df, column: sum("Relation" in line and column in line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert (scans(joint, "l_orderkey"), scans(joint, "event_id"), scans(joint, "c_custkey")) == (1, 1, 1)
    assert scans(apart, "l_orderkey") == 2
