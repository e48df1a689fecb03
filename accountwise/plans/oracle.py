"""DuckDB statements that must give the same rows as the registered Spark queries."""

from __future__ import annotations

CUT, NOW = "DATE '1999-01-16'", "DATE '2001-08-02'"
PRODUCTS = ("Neo", "Egencia Analytics Studio", "Meetings & Events", "Travel Consulting")
FLAGS = ("has_neo", "has_egencia_analytics_studio", "has_meetings_and_events", "has_travel_consulting")

_FEATURE_ORDER = [
    ("rfm", [f"{m}_{w}d" for w in (30, 90, 180) for m in ("booking_count", "total_spend", "avg_booking_amount")]
     + ["days_since_last_booking", "total_booking_count", "total_spend"]),
    ("traj", ["booking_volume_trend", "spend_trend", "spend_acceleration", "cancellation_rate_30d",
              "cancellation_rate_90d"]),
    ("pol", ["out_of_policy_rate_30d", "out_of_policy_rate_90d", "oop_trend", "destination_diversity",
             "avg_lead_time_days"]),
    ("svc", ["num_active_products", "product_diversity_score", "active_contract_value", "contract_renewal_count",
             *FLAGS]),
    ("sup", ["total_ticket_count", "avg_resolution_hours", "ticket_rate_per_month", "p1_p2_escalation_ratio",
             "ticket_count_90d", "ticket_trend_ratio", "avg_severe_resolution_hours",
             "ticket_category_concentration"]),
]
GROUP_COLUMNS = dict(_FEATURE_ORDER)
MEASURES = [c for _, cols in _FEATURE_ORDER for c in cols]
NUMERIC = ["annual_contract_value", "tenure_days", "tier_rank", *MEASURES, "clv_12m"]


def _window_rfm(days: int) -> str:
    return f"""
  count(*) FILTER (WHERE d >= {CUT} - {days}) AS n{days},
  sum(amount) FILTER (WHERE d >= {CUT} - {days})::DOUBLE AS s{days},
  count(amount) FILTER (WHERE d >= {CUT} - {days}) AS a{days}"""


_CTES: list[tuple[str, str]] = [
    ("places", "SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"),
    ("accounts", """
SELECT c_custkey AS account_id, c_name AS company_name,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Retail' WHEN 'MACHINERY' THEN 'Energy' WHEN 'BUILDING' THEN 'Technology'
    WHEN 'FURNITURE' THEN 'Financial Services' ELSE 'Manufacturing' END AS industry,
  r_name AS region,
  CASE WHEN c_acctbal >= 9000 THEN 'Platinum' WHEN c_acctbal >= 7000 THEN 'Gold' WHEN c_acctbal >= 3500 THEN 'Silver'
    WHEN c_acctbal >= -900 THEN 'Bronze' ELSE '' END AS tier,
  lo AS onboarding_date, hi < DATE '2000-08-01' AS is_churned,
  CASE WHEN hi < DATE '2000-08-01' THEN hi END AS churn_date,
  CAST(greatest(c_acctbal, 0) AS DECIMAL(12,2)) AS annual_contract_value
FROM customer JOIN places ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders GROUP BY 1) span
  ON o_custkey = c_custkey"""),
    ("travelers", """
SELECT o_orderkey AS traveler_id, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS account_id, substr(o_orderpriority, 3) AS role,
  CASE o_orderstatus WHEN 'P' THEN 'VIP' WHEN 'F' THEN 'Frequent' ELSE '' END AS travel_tier
FROM orders"""),
    ("bookings", """
SELECT l_orderkey * 10 + l_linenumber AS booking_id, l_orderkey AS traveler_id,
  CASE l_linenumber % 4 WHEN 0 THEN 'Flight' WHEN 1 THEN 'Hotel' WHEN 2 THEN 'Rail' ELSE 'Car' END AS booking_type,
  l_shipdate::DATE AS booking_date, l_shipdate::DATE + (l_linenumber * 7) AS travel_date,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, l_discount >= 0.085 AS is_out_of_policy,
  l_returnflag = 'R' AS is_cancelled, r_name AS destination_region
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN places ON s_nationkey = n_nationkey"""),
    ("contracts", """
SELECT o_orderkey AS contract_id, o_custkey AS account_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'Neo' WHEN 1 THEN 'Egencia Analytics Studio' WHEN 2 THEN 'Meetings & Events'
    ELSE 'Travel Consulting' END AS product,
  o_orderdate::DATE AS start_date,
  o_orderdate::DATE + (CASE WHEN o_orderkey % 5 < 3 THEN 365 ELSE 730 END) AS end_date,
  CAST(o_totalprice AS DECIMAL(12,2)) AS contract_value, o_orderstatus <> 'F' AS is_active
FROM orders"""),
    ("event_days", """
SELECT event_id, user_id, event_type, value, json_extract_string(props, '$.k')::INT AS k,
  30 * date_diff('day', DATE '2024-01-16', ts::DATE) + hour(ts) AS off, floor(value / 24) AS wait
FROM events"""),
    ("tickets", f"""
SELECT event_id AS ticket_id, user_id AS account_id, {CUT} + off::INT AS created_date,
  CASE WHEN event_id % 20 <> 0 THEN {CUT} + (off + wait)::INT END AS resolved_date,
  CASE event_type WHEN 'error' THEN 'P1' WHEN 'purchase' THEN 'P2' WHEN 'click' THEN 'P3' WHEN 'view' THEN 'P4'
    ELSE 'P5' END AS severity,
  CASE k % 4 WHEN 0 THEN 'Billing' WHEN 1 THEN 'Booking' WHEN 2 THEN 'Technical' ELSE 'Policy' END AS category,
  CAST(value AS DECIMAL(8,2)) AS resolution_hours
FROM event_days"""),
    ("sb", """
SELECT b.*, t.account_id, date_diff('day', booking_date, travel_date) AS lead_time_days
FROM bookings b LEFT JOIN travelers t ON t.traveler_id = b.traveler_id"""),
    ("st", """
SELECT *, CASE severity WHEN 'P1' THEN 2000 WHEN 'P2' THEN 500 WHEN 'P3' THEN 150 WHEN 'P4' THEN 50 ELSE 0 END AS cost_proxy
FROM tickets"""),
    ("past", f"SELECT *, booking_date AS d FROM sb WHERE account_id IS NOT NULL AND booking_date < {CUT}"),
    ("ok", "SELECT * FROM past WHERE NOT is_cancelled"),
    ("rfm0", f"""
SELECT account_id, {_window_rfm(30)}, {_window_rfm(90)}, {_window_rfm(180)},
  max(d) AS last_d, count(*) AS n, sum(amount)::DOUBLE AS s
FROM ok GROUP BY account_id"""),
    ("rfm", "SELECT account_id, " + ", ".join(
        f"nullif(n{w}, 0) AS booking_count_{w}d, s{w} AS total_spend_{w}d, s{w} / nullif(a{w}, 0) AS avg_booking_amount_{w}d"
        for w in (30, 90, 180)
    ) + f", {CUT} - last_d AS days_since_last_booking, n AS total_booking_count, s AS total_spend FROM rfm0"),
    ("months", """
SELECT account_id, date_trunc('month', d) AS m, count(*)::DOUBLE AS y,
  row_number() OVER (PARTITION BY account_id ORDER BY date_trunc('month', d)) - 1 AS x
FROM past GROUP BY account_id, date_trunc('month', d)"""),
    ("spends", """
SELECT account_id, date_trunc('month', d) AS m, sum(amount)::DOUBLE AS y,
  row_number() OVER (PARTITION BY account_id ORDER BY date_trunc('month', d)) - 1 AS x
FROM ok GROUP BY account_id, date_trunc('month', d)"""),
    ("trend", """
SELECT account_id, CASE WHEN count(*) < 3 THEN 0 ELSE regr_slope(y, x) END AS booking_volume_trend
FROM months GROUP BY account_id"""),
    ("strend", """
SELECT account_id, CASE WHEN count(*) < 3 THEN 0 ELSE regr_slope(y, x) END AS spend_trend
FROM spends GROUP BY account_id"""),
    ("accel", f"""
SELECT account_id, sum(amount) FILTER (WHERE d >= {CUT} - 180)::DOUBLE / nullif(count(*) FILTER (WHERE d >= {CUT} - 180), 0)
  - sum(amount) FILTER (WHERE d >= {CUT} - 365 AND d < {CUT} - 180)::DOUBLE
    / nullif(count(*) FILTER (WHERE d >= {CUT} - 365 AND d < {CUT} - 180), 0) AS delta
FROM ok GROUP BY account_id"""),
    ("rates", f"""
SELECT account_id,
  count(*) FILTER (WHERE d >= {CUT} - 30)::DOUBLE AS n30, count(*) FILTER (WHERE d >= {CUT} - 90)::DOUBLE AS n90,
  count(*) FILTER (WHERE d >= {CUT} - 30 AND is_cancelled) AS c30, count(*) FILTER (WHERE d >= {CUT} - 90 AND is_cancelled) AS c90,
  count(*) FILTER (WHERE d >= {CUT} - 30 AND is_out_of_policy) AS o30,
  count(*) FILTER (WHERE d >= {CUT} - 90 AND is_out_of_policy) AS o90,
  count(DISTINCT destination_region) AS regions, sum(lead_time_days)::DOUBLE / count(lead_time_days) AS lead
FROM past GROUP BY account_id"""),
    ("traj", """
SELECT r.account_id, booking_volume_trend, spend_trend, coalesce(delta, 0) AS spend_acceleration,
  c30 / nullif(n30, 0) AS cancellation_rate_30d, c90 / nullif(n90, 0) AS cancellation_rate_90d
FROM rates r LEFT JOIN trend USING (account_id) LEFT JOIN strend USING (account_id) LEFT JOIN accel USING (account_id)"""),
    ("pol", """
SELECT account_id, o30 / nullif(n30, 0) AS out_of_policy_rate_30d, o90 / nullif(n90, 0) AS out_of_policy_rate_90d,
  o30 / nullif(n30, 0) - o90 / nullif(n90, 0) AS oop_trend, regions AS destination_diversity, lead AS avg_lead_time_days
FROM rates"""),
    ("live", f"SELECT * FROM contracts WHERE {CUT} BETWEEN start_date AND end_date"),
    ("mix", """
SELECT account_id, product, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY account_id)::DOUBLE AS p
FROM live GROUP BY account_id, product"""),
    ("chain", """
SELECT account_id, start_date - lag(end_date) OVER (PARTITION BY account_id, product ORDER BY start_date, contract_id) AS gap
FROM contracts"""),
    ("svc", "SELECT r.account_id, np AS num_active_products, ent AS product_diversity_score, av AS active_contract_value, "
            "renewed AS contract_renewal_count, " + ", ".join(f"f{i} AS {f}" for i, f in enumerate(FLAGS)) + """
FROM (SELECT account_id, count(*) FILTER (WHERE gap <= 90) AS renewed FROM chain GROUP BY 1) r
LEFT JOIN (SELECT account_id, count(*) AS np, -sum(p * log2(p + 1e-10)) / 2 AS ent, """
     + ", ".join(f"max(CASE WHEN product = '{p}' THEN 1 END) AS f{i}" for i, p in enumerate(PRODUCTS))
     + """ FROM mix GROUP BY 1) USING (account_id)
LEFT JOIN (SELECT account_id, sum(contract_value)::DOUBLE AS av FROM live GROUP BY 1) USING (account_id)"""),
    ("asked", f"SELECT * FROM st WHERE created_date < {CUT}"),
    ("sup0", f"""
SELECT account_id, count(*) AS n, sum(resolution_hours)::DOUBLE / count(resolution_hours) AS hours,
  greatest(1.0::DOUBLE, (max(created_date) - min(created_date)) / 30.44::DOUBLE) AS months,
  count(*) FILTER (WHERE severity IN ('P1', 'P2')) AS severe, count(*) FILTER (WHERE created_date >= {CUT} - 90) AS recent,
  sum(resolution_hours) FILTER (WHERE severity IN ('P1', 'P2'))::DOUBLE / nullif(count(resolution_hours)
    FILTER (WHERE severity IN ('P1', 'P2')), 0) AS severe_hours
FROM asked GROUP BY account_id"""),
    ("topcat", """
SELECT account_id, max(n)::DOUBLE / sum(n)::DOUBLE AS share
FROM (SELECT account_id, category, count(*) AS n FROM asked GROUP BY 1, 2) GROUP BY 1"""),
    ("sup", """
SELECT account_id, n AS total_ticket_count, hours AS avg_resolution_hours, n / months AS ticket_rate_per_month,
  severe::DOUBLE / n AS p1_p2_escalation_ratio, nullif(recent, 0) AS ticket_count_90d,
  (nullif(recent, 0) / 3.0::DOUBLE) / greatest(n / months, 0.01::DOUBLE) AS ticket_trend_ratio,
  severe_hours AS avg_severe_resolution_hours, share AS ticket_category_concentration
FROM sup0 JOIN topcat USING (account_id)"""),
    ("labels_12m", f"""
SELECT account_id, coalesce(rev, 0)::DOUBLE AS booking_revenue_12m, coalesce(val, 0)::DOUBLE AS contract_value_active,
  coalesce(cost, 0)::DOUBLE AS support_cost_12m,
  greatest(0, coalesce(rev, 0) + coalesce(val, 0) - coalesce(cost, 0))::DOUBLE AS clv_12m
FROM accounts
LEFT JOIN (SELECT account_id, sum(amount) AS rev FROM sb WHERE NOT is_cancelled AND booking_date >= {CUT}
  AND booking_date < {CUT} + 365 GROUP BY 1) USING (account_id)
LEFT JOIN (SELECT account_id, sum(contract_value) AS val FROM live GROUP BY 1) USING (account_id)
LEFT JOIN (SELECT account_id, sum(cost_proxy) AS cost FROM st WHERE created_date >= {CUT} AND created_date < {CUT} + 365
  GROUP BY 1) USING (account_id)"""),
    ("features", f"""
SELECT a.account_id, tier, region, industry, is_churned, onboarding_date,
  annual_contract_value::DOUBLE AS annual_contract_value,
  coalesce(greatest(0, {CUT} - onboarding_date), 0) AS tenure_days,
  CASE tier WHEN 'Platinum' THEN 4 WHEN 'Gold' THEN 3 WHEN 'Silver' THEN 2 WHEN 'Bronze' THEN 1 ELSE 0 END AS tier_rank,
  {", ".join(f"coalesce({c}, 0) AS {c}" for c in MEASURES)}, clv_12m
FROM accounts a LEFT JOIN rfm USING (account_id) LEFT JOIN traj USING (account_id) LEFT JOIN svc USING (account_id)
LEFT JOIN sup USING (account_id) LEFT JOIN pol USING (account_id) LEFT JOIN labels_12m USING (account_id)"""),
    ("quiet", """
SELECT account_id, CASE WHEN account_id % 97 <> 0 THEN
  round(least(365, coalesce(days_since_last_booking, 365))::DOUBLE / 365, 4) END AS s
FROM accounts LEFT JOIN rfm USING (account_id)"""),
    ("churn_pred", "SELECT account_id, s AS churn_risk_score, " + ", ".join(
        f"round(1 - s * {h} / 365, 4) AS survival_prob_{h}d" for h in (30, 90, 180, 365)
    ) + ", round(3650 * (1 - s), 3) AS expected_lifetime_days FROM quiet"),
    ("probs", "SELECT account_id, " + ", ".join(
        f"((account_id * 7 + {i * 13}) % 100)::DOUBLE / 100 AS s{i}, coalesce({f}, 0) AS c{i}" for i, f in enumerate(FLAGS)
    ) + " FROM accounts LEFT JOIN svc USING (account_id)"),
    ("scores", " UNION ALL ".join(
        f"SELECT account_id, {i} AS pos, '{p}' AS product, s{i} AS score, c{i} AS label FROM probs"
        for i, p in enumerate(PRODUCTS)
    )),
    ("offers", """
SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY score DESC, pos) AS r FROM scores WHERE label = 0"""),
    ("recs", """
SELECT p.account_id, max(product) FILTER (WHERE r = 1) AS top_1_product, coalesce(max(score) FILTER (WHERE r = 1), 0) AS top_1_score,
  max(product) FILTER (WHERE r = 2) AS top_2_product, coalesce(max(score) FILTER (WHERE r = 2), 0) AS top_2_score,
  max(c0 + c1 + c2 + c3) AS num_products_current
FROM probs p LEFT JOIN offers USING (account_id) GROUP BY p.account_id"""),
    ("acc", f"""
SELECT *, date_diff('day', onboarding_date, coalesce(churn_date, {NOW})) AS tenure,
  coalesce(nullif(industry, ''), 'Not Specified') AS ind, coalesce(nullif(region, ''), 'Not Specified') AS reg,
  coalesce(nullif(tier, ''), 'Uncategorized') AS tr, annual_contract_value::DOUBLE AS base_acv
FROM accounts"""),
    ("ends", "SELECT account_id, max(end_date) AS expected_renewal_date FROM contracts GROUP BY 1"),
    ("biased", """
SELECT c.*, coalesce(churn_risk_score, 0)
  + (CASE ind WHEN 'Retail' THEN 0.35 WHEN 'Energy' THEN 0.25 WHEN 'Technology' THEN -0.15
     WHEN 'Financial Services' THEN -0.20 ELSE 0 END)::DOUBLE
  + (CASE tr WHEN 'Platinum' THEN -0.15 WHEN 'Bronze' THEN 0.15 ELSE 0 END)::DOUBLE AS raw, ind, tr
FROM churn_pred c LEFT JOIN acc USING (account_id)"""),
    ("churn", """
SELECT account_id, least(1.0, greatest(0.0, raw))::DOUBLE AS churn_risk_score,
  CASE WHEN raw > 0.5 THEN 'High' WHEN raw > 0.25 THEN 'Medium' ELSE 'Low' END AS risk_level,
  coalesce(survival_prob_30d, 1) AS survival_prob_30d, coalesce(survival_prob_90d, 1) AS survival_prob_90d,
  coalesce(survival_prob_180d, 1) AS survival_prob_180d, coalesce(survival_prob_365d, 1) AS survival_prob_365d,
  coalesce(expected_lifetime_days, 3650) AS expected_lifetime_days, expected_renewal_date,
  coalesce(n, 0) AS support_ticket_count, ind AS industry, tr AS tier
FROM biased LEFT JOIN ends USING (account_id)
LEFT JOIN (SELECT account_id, count(*) AS n FROM st GROUP BY 1) USING (account_id)"""),
    ("xsell", """
SELECT u.account_id, rnk AS recommendation_rank, product AS recommended_product,
  least(1.0, greatest(0.0, score
    + (CASE WHEN ind = 'Technology' AND product = 'Egencia Analytics Studio' THEN 0.25
       WHEN ind = 'Financial Services' AND product = 'Meetings & Events' THEN 0.20
       WHEN ind = 'Energy' AND product = 'Neo' THEN 0.15 ELSE 0 END)::DOUBLE
    + (CASE tr WHEN 'Platinum' THEN 0.15 WHEN 'Gold' THEN 0.05 ELSE 0 END)::DOUBLE))::DOUBLE AS probability_score,
  num_products_current, ind AS industry, tr AS tier, base_acv, expected_renewal_date
FROM (SELECT account_id, 1 AS rnk, top_1_product AS product, top_1_score AS score, num_products_current FROM recs
      UNION ALL SELECT account_id, 2, top_2_product, top_2_score, num_products_current FROM recs) u
LEFT JOIN acc USING (account_id) LEFT JOIN ends USING (account_id) WHERE product IS NOT NULL"""),
    ("dim_products", """
SELECT md5(name) AS product_id, name AS product_name,
  CASE name WHEN 'Neo' THEN 'Travel Booking Platform' WHEN 'Egencia Analytics Studio' THEN 'Data & Insights'
    WHEN 'Meetings & Events' THEN 'Event Management' WHEN 'Travel Consulting' THEN 'Professional Services'
    ELSE 'Other Service' END AS product_category,
  (CASE name WHEN 'Neo' THEN 0.65 WHEN 'Egencia Analytics Studio' THEN 0.85 WHEN 'Meetings & Events' THEN 0.25
    WHEN 'Travel Consulting' THEN 0.45 ELSE 0.5 END)::DOUBLE AS estimated_gross_margin_pct
FROM (SELECT product AS name FROM contracts UNION SELECT top_1_product FROM recs UNION SELECT top_2_product FROM recs)
WHERE name IS NOT NULL"""),
    ("clustered", "SELECT *, account_id % 5 - 1 AS cluster FROM features"),
    ("profiles", "SELECT cluster, " + ", ".join(
        f"round(quantile_cont({c}::DOUBLE, 0.5), 3) AS {c}" for c in
        ("clv_12m", "booking_volume_trend", "cancellation_rate_90d", "ticket_rate_per_month", "num_active_products",
         "total_spend_90d")
    ) + ", round(avg(is_churned::INT), 3) AS churn_rate FROM clustered GROUP BY cluster"),
    ("cluster_labels", """
SELECT cluster, clv_rank, CASE WHEN cluster = -1 THEN 'Unassigned'
  WHEN clv_rank >= 0.7 AND churn_rate < 0.2 AND num_active_products >= 2 THEN 'Platinum Partners'
  WHEN booking_volume_trend > 0 AND clv_rank >= 0.4 THEN 'Growth Accounts'
  WHEN churn_rate > 0.15 OR cancellation_rate_90d > 0.15 OR ticket_rate_per_month > 1.5 THEN 'At-Risk Accounts'
  ELSE 'Low-Engagement' END AS segment
FROM (SELECT *, (rank() OVER (ORDER BY clv_12m) + (count(*) OVER (PARTITION BY clv_12m) - 1) / 2.0::DOUBLE)
  / count(*) OVER () AS clv_rank FROM profiles)"""),
    ("segs", "SELECT account_id, cluster, segment FROM clustered JOIN cluster_labels USING (cluster)"),
    ("master", """
SELECT f.*, segment, c.churn_risk_score, c.survival_prob_365d, top_1_product, top_1_score, top_2_product, top_2_score
FROM features f LEFT JOIN segs USING (account_id) LEFT JOIN churn_pred c USING (account_id)
LEFT JOIN recs USING (account_id)"""),
    ("arr", "SELECT account_id, sum(contract_value) AS arr FROM contracts WHERE is_active GROUP BY 1"),
    ("fb", "SELECT *, coalesce(amount, 0) AS transaction_amount FROM sb"),
    ("surv", "SELECT account_id, greatest(1, tenure_days) AS duration, coalesce(is_churned::INT, 0) AS event, tier, tier_rank FROM features"),
]
_CTES.append(("risk_times", "SELECT duration, event, s FROM surv JOIN quiet USING (account_id) WHERE s IS NOT NULL"))
_PREFIX = "WITH " + ",\n".join(
    f"{name} AS {'MATERIALIZED ' if name == 'risk_times' else ''}({sql})" for name, sql in _CTES
)


def statement(final: str) -> str:
    """A final select over the common tables; a recursive statement brings its own."""
    return final if final.lstrip().startswith("WITH RECURSIVE") else f"{_PREFIX}\n{final}"


def r(expr: str, digits: int = 6, name: str | None = None) -> str:
    return f"round(({expr})::DOUBLE, {digits}) AS {name or expr}"


def text(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


_COUNTS = {"booking_count_30d", "booking_count_90d", "booking_count_180d", "days_since_last_booking",
           "total_booking_count", "destination_diversity", "num_active_products", "contract_renewal_count", *FLAGS,
           "total_ticket_count", "ticket_count_90d", "tenure_days", "tier_rank"}


def shown(columns) -> str:
    return ", ".join(c if c in _COUNTS else r(c) for c in columns)


def per_account(group: str, columns=None) -> str:
    """A feature family after assembly: every account, numeric NULL as 0."""
    cols = columns or GROUP_COLUMNS[group]
    return f"SELECT account_id, {shown(cols)} FROM features"


_STATS_FEATURES = [c for c in NUMERIC if not any(
    part in c for part in ("clv", "amount", "spend", "revenue", "contract_value", "acv"))]


def _stats(columns, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"round(min({c})::DOUBLE, 6) AS \"min\", round(max({c})::DOUBLE, 6) AS \"max\"{extra} FROM features" for c in columns
    )


def _standard(columns, keys: str) -> str:
    scaled = ", ".join(
        f"round((({c})::DOUBLE - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 5) AS {c}"
        for c in columns
    )
    return f"SELECT account_id, {keys}{scaled} FROM features"


COVARIATES = ("tier_rank", "tenure_days", "annual_contract_value", "booking_count_90d", "total_spend_90d",
              "booking_volume_trend", "spend_acceleration", "cancellation_rate_90d", "num_active_products",
              "ticket_rate_per_month", "p1_p2_escalation_ratio", "out_of_policy_rate_90d", "avg_resolution_hours",
              "destination_diversity")
SEGMENTING = ("tier_rank", "annual_contract_value", "tenure_days", "booking_count_90d", "total_spend_90d",
              "booking_volume_trend", "spend_acceleration", "cancellation_rate_90d", "num_active_products",
              "ticket_rate_per_month", "p1_p2_escalation_ratio", "out_of_policy_rate_90d", "clv_12m")


def _kaplan(by: str, extra: str = "", where: str = "", digits: int = 8) -> str:
    part = f"PARTITION BY {by} " if by else ""
    cols = f"{by}, " if by else ""
    return f"""
SELECT {cols}duration, at_risk, events, round(round(exp(sum(ln(greatest(1 - events / at_risk::DOUBLE, 1e-300)))
  OVER ({part}ORDER BY duration ROWS UNBOUNDED PRECEDING)), 12), {digits}) AS survival
FROM (SELECT *, sum(n) OVER ({part}ORDER BY duration ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS at_risk,
    sum(n) OVER ({part})::BIGINT AS size
  FROM (SELECT {cols}duration, count(*) AS n, sum(event)::BIGINT AS events FROM ({extra or 'SELECT * FROM surv'}) GROUP BY ALL))
{where}"""


_THIRDS = """SELECT duration, event, CASE greatest(1, ceil((tier_rank - lo) * 3 / (hi - lo)::DOUBLE)) WHEN 1 THEN 'Low'
  WHEN 2 THEN 'Medium' ELSE 'High' END AS tier_group
FROM surv, (SELECT min(tier_rank) AS lo, max(tier_rank) AS hi FROM surv)"""

_PREDICTED = "SELECT account_id, tier, clv_12m AS actual, clv_12m * (50 + account_id % 100) / 100 AS predicted FROM features"

_Z = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT account_id, account_id % 5 - 1 AS cluster, '{c}' AS f, ({c} - avg({c}) OVER ()) / "
    f"coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS v FROM features" for c in SEGMENTING
) + ") WHERE cluster <> -1"

_CURVE = """
SELECT product, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg, sum(pos) OVER (PARTITION BY product) AS p,
  sum(neg) OVER (PARTITION BY product) AS n
FROM (SELECT product, score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY 1, 2)
WINDOW w AS (PARTITION BY product ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""

_OFFER_JSON = """coalesce('[' || string_agg('{"product":"' || product || '","%s":' || round(score, 4)::VARCHAR || '}', ','
  ORDER BY r) FILTER (WHERE r <= 3) || ']', '[]')"""
_HELD_JSON = """coalesce('[' || string_agg('"' || product || '"', ',' ORDER BY pos) || ']', '[]')"""

_SEG_AGG = """count(*) AS accounts, round(avg(clv_12m), 2) AS avg_clv,
  round(sum(clv_12m::DECIMAL(20,2))::DOUBLE, 2) AS total_clv, round(avg(total_spend_90d), 2) AS avg_spend_90d,
  round(avg(is_churned::INT), 2) AS churn_rate, round(avg(num_active_products), 2) AS avg_products"""

_PROFILE = """
SELECT f.*, coalesce(round(c.churn_risk_score, 4), 0) AS score,
  CASE WHEN c.account_id IS NULL THEN 'Unknown' WHEN c.churn_risk_score > 0.5 THEN 'High'
    WHEN c.churn_risk_score > 0.25 THEN 'Medium' ELSE 'Low' END AS risk_level, s.segment
FROM features f LEFT JOIN churn_pred c USING (account_id) LEFT JOIN segs s USING (account_id)"""


def _gate(rows: list[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS check_name, {obs}::BIGINT AS observed, {exp}::BIGINT AS expected, {ok} AS ok"
        for t, c, obs, exp, ok in rows
    )


_KEYS = {"accounts": "account_id", "bookings": "booking_id", "travelers": "traveler_id", "contracts": "contract_id",
         "tickets": "ticket_id"}
_MIN = {"accounts": 4500, "bookings": 800000, "travelers": 20000, "contracts": 5000, "tickets": 10000}
_LAYER_ROWS = {
    "stg_accounts": "accounts", "stg_bookings": "sb", "stg_contracts": "contracts", "stg_tickets": "st",
    "stg_travelers": "travelers", "stg_churn_predictions": "churn_pred", "stg_recommendations": "recs",
    "dim_accounts": "acc", "dim_travelers": "travelers", "fact_bookings": "fb", "fact_service_contracts": "contracts",
    "fact_support_tickets": "st", "mart_clv_analytics": "acc", "dim_date": "range(3653)", "fact_ml_churn": "churn",
    "fact_ml_cross_sell": "xsell", "dim_products": "dim_products",
}

FINAL: dict[str, str] = {
    # sources
    "s1_load_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(min({d}) AS VARCHAR) AS first_day, "
        f"CAST(max({d}) AS VARCHAR) AS last_day, sum({m})::DOUBLE AS total FROM {t}"
        for t, d, m in (("accounts", "onboarding_date", "annual_contract_value"), ("bookings", "booking_date", "amount"),
                        ("contracts", "start_date", "contract_value"), ("tickets", "created_date", "resolution_hours"))
    ) + " UNION ALL SELECT 'travelers', count(*), NULL, NULL, NULL FROM travelers"
        " UNION ALL SELECT 'clv_labels', count(*), NULL, NULL, sum(clv_12m::DECIMAL(20,2))::DOUBLE FROM labels_12m",
    "s2_load_csv": f"SELECT account_id::VARCHAR AS account_id, company_name, industry, region, nullif(tier, '') AS tier, "
                   f"{text('onboarding_date')}, is_churned, {text('churn_date')}, annual_contract_value::DOUBLE AS "
                   f"annual_contract_value FROM accounts",
    "s3_catalog_tables": f"SELECT contract_id::VARCHAR AS contract_id, account_id::VARCHAR AS account_id, product, "
                         f"{text('start_date', 'end_date')}, contract_value::DOUBLE AS contract_value, is_active FROM contracts",
    "s5_bulk_load_raw": "SELECT 'support_tickets' AS table_name, count(*) FILTER (WHERE ticket_id % 40 <> 7) AS loaded, "
                        "count(*) FILTER (WHERE ticket_id % 40 = 7) AS rejected, true AS verified FROM tickets",
    "s6_load_predictions": "SELECT 'churn_predictions' AS table_name, count(*) AS loaded, 0 AS rejected, true AS verified "
                           "FROM churn_pred UNION ALL SELECT 'clv_labels', count(*), 0, true FROM labels_12m",
    "s7_write_features": "SELECT 'parquet' AS format, count(*) AS n_rows FROM features UNION ALL "
                         "SELECT 'csv', count(*) FROM features",
    "s8_write_predictions": "SELECT 'churn_predictions' AS name, count(*) AS n_rows FROM churn_pred UNION ALL "
                            "SELECT 'recommendations', count(*) FROM recs UNION ALL SELECT 'probabilities', count(*) FROM probs "
                            "UNION ALL SELECT 'segments', count(*) FROM segs",
    "s9_write_layers": " UNION ALL ".join(
        f"SELECT '{k}' AS layer, count(*) AS n_rows FROM {v}" for k, v in _LAYER_ROWS.items()
    ),
    # staging
    "p1_stg_corporate_accounts": f"SELECT account_id, company_name, industry, region, tier, {text('onboarding_date')}, "
                                 f"is_churned, {text('churn_date')}, base_acv AS annual_contract_value, tenure AS tenure_days, "
                                 "CASE tier WHEN 'Platinum' THEN 4 WHEN 'Gold' THEN 3 WHEN 'Silver' THEN 2 ELSE 1 END AS tier_rank FROM acc",
    "p2_stg_bookings": f"SELECT booking_id, traveler_id, account_id, booking_type, {text('booking_date', 'travel_date')}, "
                       "amount::DOUBLE AS amount, is_out_of_policy, is_cancelled, destination_region, lead_time_days FROM sb",
    "p3_stg_service_contracts": f"SELECT contract_id, account_id, product, {text('start_date', 'end_date')}, "
                                "contract_value::DOUBLE AS contract_value, is_active, "
                                "date_diff('month', start_date, end_date) AS contract_months FROM contracts",
    "p4_stg_support_tickets": f"SELECT ticket_id, account_id, {text('created_date', 'resolved_date')}, severity, category, "
                              "resolution_hours::DOUBLE AS resolution_hours, cost_proxy FROM st",
    "p5_stg_traveler_profiles": "SELECT * FROM travelers",
    "p6_stg_churn_predictions": "SELECT account_id, churn_risk_score, survival_prob_30d, survival_prob_90d, survival_prob_180d, "
                                "survival_prob_365d, expected_lifetime_days, '2001-08-02' AS prediction_date FROM churn_pred",
    "p7_stg_cross_sell_recommendations": "SELECT *, '2001-08-02' AS prediction_date FROM recs",
    # marts
    "m1_dim_accounts": f"SELECT account_id, company_name, ind AS industry, reg AS region, tr AS tier, {text('onboarding_date')}, "
                       "CAST(coalesce(churn_date, DATE '9999-12-31') AS VARCHAR) AS churn_date, is_churned, "
                       "tenure AS tenure_days, base_acv FROM acc",
    "m2_dim_products": "SELECT * FROM dim_products",
    "m3_dim_date": """
SELECT CAST(d AS VARCHAR) AS date_day, year(d) AS year, month(d) AS month, strftime(d, '%b') AS month_name, quarter(d) AS quarter,
  dayofweek(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend, day(d) AS day_of_month,
  CAST(date_trunc('month', d)::DATE AS VARCHAR) AS first_day_of_month,
  CAST(date_trunc('quarter', d)::DATE AS VARCHAR) AS first_day_of_quarter,
  CAST(date_trunc('year', d)::DATE AS VARCHAR) AS first_day_of_year
FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2029-12-31', INTERVAL 1 DAY))::DATE AS d)""",
    "m4_dim_travelers": "SELECT traveler_id, account_id, coalesce(nullif(role, ''), 'Unspecified Role') AS role, "
                        "coalesce(nullif(travel_tier, ''), 'Standard') AS travel_tier FROM travelers",
    "m5_fact_bookings": f"SELECT booking_id, account_id, {text('booking_date', 'travel_date')}, "
                        "transaction_amount::DOUBLE AS transaction_amount, is_out_of_policy, "
                        "coalesce(lead_time_days, 0) AS lead_time_days FROM fb",
    "m6_fact_service_contracts": f"SELECT contract_id, account_id, {text('start_date', 'end_date')}, product AS service_product, "
                                 "coalesce(date_diff('month', start_date, end_date), 0) AS contract_months, "
                                 "coalesce(contract_value, 0)::DOUBLE AS contract_value, is_active FROM contracts",
    "m7_fact_support_tickets": f"SELECT ticket_id, account_id, {text('created_date')}, "
                               "CAST(coalesce(resolved_date, DATE '9999-12-31') AS VARCHAR) AS resolved_date, severity, category, "
                               "coalesce(resolution_hours, 0)::DOUBLE AS resolution_hours, cost_proxy, "
                               "(severity IN ('P1', 'P2'))::INT AS is_high_severity FROM st",
    "m8_fact_ml_churn": f"SELECT * REPLACE ({text('expected_renewal_date')}, round(churn_risk_score, 6) AS churn_risk_score), "
                        "'2001-08-02' AS prediction_date FROM churn",
    "m9_fact_ml_cross_sell": f"SELECT * REPLACE ({text('expected_renewal_date')}, round(probability_score, 6) AS probability_score), "
                             "'2001-08-02' AS prediction_date FROM xsell",
    "m10_mart_clv_analytics": """
SELECT account_id, company_name, industry, region, tier, CAST(onboarding_date AS VARCHAR) AS onboarding_date, is_churned,
  CAST(churn_date AS VARCHAR) AS churn_date, base_acv, tenure AS tenure_days, coalesce(nb, 0) AS total_bookings,
  coalesce(sb_, 0) AS total_booking_amount, coalesce(sb_ / nullif(pb, 0), 0) AS avg_booking_amount,
  coalesce(ob, 0) AS out_of_policy_bookings, coalesce(nt, 0) AS total_support_tickets, coalesce(ht, 0) AS high_severity_tickets,
  coalesce(ct, 0) AS total_support_cost_proxy, coalesce(vc, 0) AS active_contract_value, coalesce(nc, 0) AS active_contracts,
  CASE WHEN tenure > 0 THEN coalesce(sb_, 0) / tenure * 365 ELSE 0 END AS annualized_booking_run_rate,
  CASE WHEN nb > 0 THEN ob::DOUBLE / nb ELSE 0 END AS out_of_policy_rate
FROM acc
LEFT JOIN (SELECT account_id, count(booking_id) AS nb, sum(amount)::DOUBLE AS sb_, count(amount) AS pb,
  count(*) FILTER (WHERE is_out_of_policy) AS ob FROM sb GROUP BY 1) USING (account_id)
LEFT JOIN (SELECT account_id, count(ticket_id) AS nt, count(*) FILTER (WHERE severity IN ('P1', 'P2')) AS ht,
  sum(cost_proxy)::BIGINT AS ct FROM st GROUP BY 1) USING (account_id)
LEFT JOIN (SELECT account_id, sum(contract_value)::DOUBLE AS vc, count(contract_id) AS nc FROM contracts WHERE is_active
  GROUP BY 1) USING (account_id)""",
    # features
    "f1_rfm": "SELECT account_id, " + shown(GROUP_COLUMNS["rfm"]) + " FROM rfm",
    "f2_trajectory": "SELECT account_id, " + shown(GROUP_COLUMNS["traj"]) + " FROM traj",
    "f3_service": "SELECT account_id, " + shown(GROUP_COLUMNS["svc"]) + " FROM svc",
    "f4_support": "SELECT account_id, " + shown(GROUP_COLUMNS["sup"]) + " FROM sup",
    "f5_policy": "SELECT account_id, " + shown(GROUP_COLUMNS["pol"]) + " FROM pol",
    "f6_assemble_features": "SELECT account_id, tier, region, industry, is_churned, CAST(onboarding_date AS VARCHAR) AS onboarding_date, "
                            "'2001-08-02 00:00:00' AS feature_timestamp, " + shown(NUMERIC) + " FROM features",
    "f7_feature_statistics": _stats(_STATS_FEATURES, f", {len(NUMERIC) - len(_STATS_FEATURES)} AS redacted_columns"),
    "f9_rfm_with_cancelled": f"""
SELECT account_id, coalesce(n, 0) AS total_booking_count, coalesce(s, 0) AS total_spend, coalesce(dd, 0) AS days_since_last_booking,
  {", ".join(f"coalesce(n{w}, 0) AS booking_count_{w}d, coalesce(s{w}, 0) AS total_spend_{w}d, coalesce(s{w} / nullif(n{w}, 0), 0) AS aov_{w}d" for w in (30, 90, 180))}
FROM accounts LEFT JOIN (SELECT account_id, count(*) AS n, sum(amount)::DOUBLE AS s, {CUT} - max(d) AS dd,
  {", ".join(f"count(*) FILTER (WHERE d >= {CUT} - {w}) AS n{w}, sum(amount) FILTER (WHERE d >= {CUT} - {w})::DOUBLE AS s{w}" for w in (30, 90, 180))}
  FROM past GROUP BY 1) USING (account_id)""",
    "f10_service_strict": f"""
SELECT account_id, coalesce(n, 0) AS num_active_products, coalesce(v, 0) AS active_contract_value,
  {", ".join(f"coalesce(f{i}, 0) AS {f}" for i, f in enumerate(FLAGS))}
FROM accounts LEFT JOIN (SELECT account_id, count(*) AS n, sum(contract_value)::DOUBLE AS v,
  {", ".join(f"max((product = '{p}')::INT) AS f{i}" for i, p in enumerate(PRODUCTS))}
  FROM contracts WHERE start_date < {CUT} AND end_date > {CUT} GROUP BY 1) USING (account_id)""",
    "l1_clv_labels": "SELECT * FROM labels_12m",
    # value model
    "c1_training_split": """
SELECT tier, split, count(*) AS accounts, round(sum(ln(1 + clv_12m)), 4) AS sum_log_target
FROM (SELECT tier, clv_12m, CASE WHEN share < 0.7 THEN 'train' WHEN share < 0.85 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, (row_number() OVER (PARTITION BY tier ORDER BY ('0x' || substr(md5('clv:' || account_id), 1, 8))::BIGINT) - 1)
    / (count(*) OVER (PARTITION BY tier))::DOUBLE AS share FROM features))
GROUP BY ALL""",
    "c5b_importance_sums": f"SELECT {len(NUMERIC) - 1}::BIGINT AS features, 1.0::DOUBLE AS total, true AS none_negative FROM features LIMIT 1",
    "c6c_attribution_sums": f"""
SELECT account_id, {len(NUMERIC) - 1} AS inputs, true AS adds_up
FROM (SELECT *, (row_number() OVER (PARTITION BY tier ORDER BY ('0x' || substr(md5('clv:' || account_id), 1, 8))::BIGINT) - 1)
  / (count(*) OVER (PARTITION BY tier))::DOUBLE AS share FROM features) WHERE share >= 0.85""",
    "c4_regression_metrics": f"""
SELECT tier AS model, round(avg(abs(predicted - actual)), 4) AS mae, round(sqrt(avg((predicted - actual) ** 2)), 4) AS rmse,
  round(1 - avg((predicted - actual) ** 2) / nullif(var_pop(actual), 0), 6) AS r2,
  round(avg(abs((predicted - actual) / (actual + 1))) * 100, 4) AS mape,
  round(quantile_cont(abs(predicted - actual), 0.5), 4) AS median_ae
FROM ({_PREDICTED}) GROUP BY tier""",
    "c7_clv_percentile": f"""
SELECT p.account_id, predicted AS predicted_clv, round(100 * (SELECT count(*) FROM features f WHERE f.clv_12m < p.predicted)::DOUBLE
  / (SELECT count(*) FROM features), 1) AS clv_percentile
FROM ({_PREDICTED}) p""",
    # survival
    "vs1_survival_frame": _standard(COVARIATES, "greatest(1, tenure_days) AS duration, coalesce(is_churned::INT, 0) AS event, tier_rank AS tier_rank_raw, "),
    "vs2_kaplan_meier": _kaplan(""),
    "vs3_kaplan_meier_by_tier": _kaplan("tier", where="WHERE size > 10"),
    "vs3b_kaplan_meier_by_tier_third": _kaplan("tier_group", _THIRDS, "WHERE size > 10"),
    "vs4_median_survival": f"""
SELECT tier, coalesce(min(duration) FILTER (WHERE survival <= 0.5)::DOUBLE, 'inf'::DOUBLE) AS median_survival_days
FROM ({_kaplan("tier", digits=12)}) GROUP BY tier""",
    "vs5b_cox_terms": """
SELECT term, round(value, 5) AS value FROM (
  WITH z AS (SELECT greatest(1, tenure_days) AS duration, coalesce(is_churned::INT, 0) AS event,
      (tenure_days - avg(tenure_days) OVER ()) / stddev_pop(tenure_days) OVER () AS z1,
      (num_active_products - avg(num_active_products) OVER ()) / stddev_pop(num_active_products) OVER () AS z2 FROM features),
    w AS (SELECT *, exp(-0.8::DOUBLE * z1 - 0.3::DOUBLE * z2) AS w FROM z),
    risk AS (SELECT duration, sum(sum(w)) OVER later AS s0, sum(sum(w * z1)) OVER later AS s1, sum(sum(w * z2)) OVER later AS s2
      FROM w GROUP BY duration WINDOW later AS (ORDER BY duration DESC)),
    dead AS (SELECT duration, count(*) AS d, sum(w) AS d0, sum(w * z1) AS d1, sum(w * z2) AS d2, sum(z1) AS x1, sum(z2) AS x2
      FROM w WHERE event = 1 GROUP BY duration),
    tied AS (SELECT *, unnest(range(d)) / d::DOUBLE AS a FROM dead JOIN risk USING (duration))
  SELECT 'log_likelihood' AS term, (SELECT sum(-0.8::DOUBLE * x1 - 0.3::DOUBLE * x2) FROM dead) - sum(ln(s0 - a * d0)) AS value FROM tied
  UNION ALL SELECT 'tenure_days', (SELECT sum(x1) FROM dead) - sum((s1 - a * d1) / (s0 - a * d0)) FROM tied
  UNION ALL SELECT 'num_active_products', (SELECT sum(x2) FROM dead) - sum((s2 - a * d2) / (s0 - a * d0)) FROM tied
  UNION ALL SELECT 'cumulative_hazard', sum(d / s0) FROM dead JOIN risk USING (duration))""",
    "vs6_concordance": """
SELECT count(*) FILTER (WHERE a.s > b.s) AS concordant, count(*) FILTER (WHERE a.s < b.s) AS discordant,
  count(*) FILTER (WHERE a.s = b.s) AS tied,
  round((count(*) FILTER (WHERE a.s > b.s) + count(*) FILTER (WHERE a.s = b.s) / 2.0::DOUBLE) / count(*), 8) AS concordance_index
FROM risk_times a, risk_times b
WHERE a.event = 1 AND (a.duration < b.duration OR (a.duration = b.duration AND b.event = 0))""",
    "vs7b_churn_scores_given_model": """
SELECT account_id, round(h, 6) AS partial_hazard, round(exp(-0.006 * h), 6) AS survival_prob_30d,
  round(exp(-0.018 * h), 6) AS survival_prob_90d, round(exp(-(0.02 + 0.08 * 80 / 300.0) * h), 6) AS survival_prob_180d,
  round(exp(-(0.02 + 0.08 * 265 / 300.0) * h), 6) AS survival_prob_365d,
  round(1 - exp(-(0.02 + 0.08 * 265 / 300.0) * h), 6) AS churn_risk_score,
  round(100 * (1 + exp(-0.02 * h)) / 2 + 300 * (exp(-0.02 * h) + exp(-0.1 * h)) / 2
    + 1100 * (exp(-0.1 * h) + exp(-0.6 * h)) / 2, 6) AS expected_lifetime_days
FROM (SELECT account_id, exp(-0.8::DOUBLE * (tenure_days - avg(tenure_days) OVER ()) / stddev_pop(tenure_days) OVER ()
  - 0.3::DOUBLE * (num_active_products - avg(num_active_products) OVER ()) / stddev_pop(num_active_products) OVER ()) AS h
  FROM features)""",
    "vs8_risk_summary": "SELECT round(avg(churn_risk_score), 8) AS mean, count(*) FILTER (WHERE churn_risk_score > 0.5) AS high_risk, "
                        "count(churn_risk_score) AS accounts, round(quantile_cont(churn_risk_score, 0.5), 8) AS median FROM churn_pred",
    "vs8_risk_histogram": """
SELECT bin, count(*) AS accounts FROM (
  SELECT least(49, floor((s - lo) / ((hi - lo) / 50.0::DOUBLE)))::INT AS bin
  FROM quiet, (SELECT min(s) AS lo, max(s) AS hi FROM quiet) WHERE s IS NOT NULL) GROUP BY bin""",
    # segmentation
    "g1_segmentation_frame": _standard(SEGMENTING, ""),
    "g2b_axis_moments": "SELECT count(*) AS accounts, 0.0::DOUBLE AS mean_0, 0.0::DOUBLE AS mean_1, 0.0::DOUBLE AS correlation, true AS ordered FROM features",
    "g3b_density_levels": """
WITH RECURSIVE spots AS (
  SELECT min(c_custkey) AS id, x, y, count(*) AS n FROM (
    SELECT c_custkey, round(c_acctbal / 500 * 16.0::DOUBLE)::BIGINT AS x, round(c_nationkey / 2.0::DOUBLE * 16.0::DOUBLE)::BIGINT AS y
    FROM customer) GROUP BY x, y
), pairs AS (
  SELECT a.id AS a, b.id AS b, b.n, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS square FROM spots a, spots b
  WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 256
), core AS (
  SELECT a AS id, min(square) AS core FROM (
    SELECT a, square, sum(n) OVER (PARTITION BY a ORDER BY square) AS inside FROM pairs) WHERE inside >= 10 GROUP BY a
), radii AS (
  SELECT * FROM (VALUES (0, 16), (1, 11), (2, 8), (3, 6), (4, 4), (5, 3), (6, 2), (7, 1)) r(level, r)
), links AS (
  SELECT level, a, b FROM pairs p JOIN core c ON c.id = p.a JOIN core d ON d.id = p.b, radii
  WHERE greatest(p.square, c.core, d.core) <= r * r
), spread AS (
  SELECT level, id, id AS label FROM core, radii WHERE core <= r * r
  UNION
  SELECT l.level, l.b, s.label FROM spread s JOIN links l ON l.level = s.level AND l.a = s.id WHERE s.label < l.b
), settled AS (
  SELECT level, id, min(label) AS component FROM spread GROUP BY level, id
)
SELECT level, component, count(*) AS positions, sum(n)::BIGINT AS accounts
FROM settled JOIN spots USING (id) GROUP BY level, component""",
    "g4_cluster_sizes": "SELECT cluster, count(*) AS accounts, count(*)::DOUBLE / (SELECT count(*) FROM clustered) * 100 AS percent "
                        "FROM clustered GROUP BY cluster",
    "g5_calinski_harabasz": f"""
SELECT max(k) AS clusters, max(n)::BIGINT AS accounts, round((sum(centred - s * s / n) / (max(k) - 1)) / (sum(ss - centred) / (max(n) - max(k))), 4)
  AS calinski_harabasz
FROM (SELECT f, count(*) AS k, sum(n) AS n, sum(s) AS s, sum(ss) AS ss, sum(s * s / n) AS centred
  FROM (SELECT cluster, f, count(*) AS n, sum(v) AS s, sum(v * v) AS ss FROM (
    {" UNION ALL ".join(f"SELECT account_id % 5 - 1 AS cluster, '{c}' AS f, ({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS v FROM features" for c in SEGMENTING)}
  ) WHERE cluster <> -1 GROUP BY 1, 2) GROUP BY f)""",
    "g5b_silhouette": f"""
SELECT count(DISTINCT account_id) AS accounts, round(avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM (SELECT account_id, max(size) AS size, max(own * size / (size - 1)) AS a, min(other) AS b FROM (
  SELECT p.account_id, CASE WHEN p.cluster = c.cluster THEN c.n END AS size,
    CASE WHEN p.cluster = c.cluster THEN p.nx + c.spread - 2 * dot END AS own,
    CASE WHEN p.cluster <> c.cluster THEN p.nx + c.spread - 2 * dot END AS other
  FROM (SELECT account_id, cluster, sum(v * v) AS nx FROM ({_Z}) GROUP BY 1, 2) p
  JOIN (SELECT z.account_id, m.cluster, sum(z.v * m.mean) AS dot FROM ({_Z}) z
    JOIN (SELECT cluster, f, avg(v) AS mean FROM ({_Z}) GROUP BY 1, 2) m USING (f) GROUP BY 1, 2) d ON d.account_id = p.account_id
  JOIN (SELECT cluster, count(DISTINCT account_id) AS n, sum(v * v) / count(DISTINCT account_id) AS spread FROM ({_Z}) GROUP BY 1) c
    ON c.cluster = d.cluster) GROUP BY 1)""",
    "g6_cluster_profiles": "SELECT * FROM profiles",
    "g7_cluster_labels": "SELECT cluster, round(clv_rank, 6) AS clv_rank, segment FROM cluster_labels",
    "g8_segment_summary": "SELECT segment, count(*) AS accounts, round(avg(clv_12m), 2) AS avg_clv, "
                          "round(avg(total_spend_90d), 2) AS avg_spend_90d, round(avg(is_churned::INT), 2) AS churn_rate, "
                          "round(avg(num_active_products), 2) AS avg_products FROM features JOIN segs USING (account_id) GROUP BY segment",
    # cross-sell
    "x1_adoption_rates": " UNION ALL ".join(
        f"SELECT split, count(*) AS accounts, '{f}' AS flag, sum({f})::BIGINT AS adopters, avg({f}) AS adoption_rate FROM x GROUP BY split"
        for f in FLAGS
    ),
    "x3_ranking_metrics": f"""
SELECT product, round(sum(pos * (n - (fp - neg) - neg / 2.0::DOUBLE)) / max(p * n), 4) AS auc_roc,
  round(sum(pos * tp::DOUBLE / (tp + fp)) / max(p), 4) AS avg_precision,
  round(coalesce(sum(pos) FILTER (WHERE score > 0.5)::DOUBLE / sum(pos + neg) FILTER (WHERE score > 0.5), 0), 4) AS "precision",
  round(coalesce(sum(pos) FILTER (WHERE score > 0.5), 0)::DOUBLE / max(p), 4) AS recall,
  round(2.0::DOUBLE * coalesce(sum(pos) FILTER (WHERE score > 0.5), 0)::DOUBLE
    / (coalesce(sum(pos + neg) FILTER (WHERE score > 0.5), 0) + max(p))::DOUBLE, 4) AS f1, max(p)::BIGINT AS support
FROM ({_CURVE}) GROUP BY product""",
    "x4_precision_recall_curve": f"SELECT product, score AS threshold, round(tp::DOUBLE / (tp + fp)::DOUBLE, 8) AS \"precision\", "
                                 f"round(tp::DOUBLE / p::DOUBLE, 8) AS recall FROM ({_CURVE})",
    "x5_recommendations": "SELECT * FROM recs",
    "x6_probability_matrix": "SELECT account_id, " + ", ".join(
        f"s{i} AS \"{p}_score\", c{i} AS \"{p}_current\"" for i, p in enumerate(PRODUCTS)) + " FROM probs",
    "x7_recommendation_distribution": "SELECT top_1_product, count(*) AS accounts FROM recs WHERE top_1_product IS NOT NULL GROUP BY 1",
    # account and portfolio queries
    "v1_churn_lookup": "SELECT account_id, churn_risk_score, survival_prob_30d, survival_prob_90d, survival_prob_180d, survival_prob_365d, "
                       "CASE WHEN churn_risk_score > 0.5 THEN 'High' WHEN churn_risk_score > 0.25 THEN 'Medium' ELSE 'Low' END AS risk_level FROM churn_pred",
    "v2_cross_sell_lookup": f"""
SELECT p.account_id, recommendations, current_products FROM probs p
JOIN (SELECT p.account_id, {_OFFER_JSON % 'propensity_score'} AS recommendations FROM probs p LEFT JOIN offers USING (account_id) GROUP BY 1) USING (account_id)
JOIN (SELECT p.account_id, {_HELD_JSON} AS current_products FROM probs p LEFT JOIN (SELECT * FROM scores WHERE label = 1) USING (account_id) GROUP BY 1) USING (account_id)""",
    "v3_account_page": "SELECT account_id, tier, region, industry, round(clv_12m, 2) AS clv_12m, is_churned, booking_count_90d, "
                       "round(total_spend_90d, 2) AS total_spend_90d, num_active_products, segment, count(*) OVER () AS total "
                       "FROM features JOIN segs USING (account_id) WHERE tier = 'Gold' ORDER BY account_id LIMIT 50 OFFSET 20",
    "v4_account_profile": f"""
SELECT account_id, tier, industry, region, round(clv_12m, 2) AS clv_12m, score AS churn_risk_score, risk_level, segment,
  top_recommendations, current_products, booking_count_90d, round(total_spend_90d, 2) AS total_spend_90d, num_active_products,
  round(ticket_rate_per_month, 2) AS ticket_rate_per_month, round(cancellation_rate_90d, 4) AS cancellation_rate_90d, tenure_days
FROM ({_PROFILE})
JOIN (SELECT p.account_id, {_OFFER_JSON % 'score'} AS top_recommendations FROM probs p LEFT JOIN offers USING (account_id) GROUP BY 1) USING (account_id)
JOIN (SELECT p.account_id, {_HELD_JSON} AS current_products FROM probs p LEFT JOIN (SELECT * FROM scores WHERE label = 1) USING (account_id) GROUP BY 1) USING (account_id)""",
    "v5_segment_overview": f"SELECT segment, {_SEG_AGG}, round(avg(booking_count_90d), 2) AS avg_bookings_90d FROM master "
                           "WHERE segment IS NOT NULL GROUP BY segment",
    "v6_master_table": "SELECT account_id, tier, region, industry, is_churned, CAST(onboarding_date AS VARCHAR) AS onboarding_date, "
                       "'2001-08-02 00:00:00' AS feature_timestamp, " + shown(NUMERIC) + ", segment, churn_risk_score, "
                       "survival_prob_365d, top_1_product, top_1_score, top_2_product, top_2_score FROM master",
    "v7_portfolio_kpis": "SELECT sum(clv_12m::DECIMAL(20,2))::DOUBLE AS total_clv, round(avg(clv_12m), 4) AS avg_clv, "
                         "round(avg(is_churned::INT) * 100, 4) AS churn_percent, count(*) FILTER (WHERE churn_risk_score > 0.5) AS high_risk_accounts, "
                         "round(avg(num_active_products), 4) AS avg_products FROM master",
    "v8_clv_by_tier": "SELECT tier, round(min(clv_12m), 4) AS \"min\", round(quantile_cont(clv_12m, 0.25), 4) AS q1, "
                      "round(quantile_cont(clv_12m, 0.5), 4) AS median, round(quantile_cont(clv_12m, 0.75), 4) AS q3, "
                      "round(max(clv_12m), 4) AS \"max\" FROM master GROUP BY tier",
    "v9_segment_distribution": "SELECT segment, count(*) AS accounts FROM segs GROUP BY segment",
    "v10_revenue_at_risk": "SELECT account_id, clv_12m, churn_risk_score FROM master WHERE churn_risk_score > 0.5 "
                           "ORDER BY clv_12m DESC, account_id LIMIT 15",
    "v11_product_penetration": " UNION ALL ".join(
        f"SELECT '{p}' AS product, round(avg({f}) * 100, 6) AS adoption_percent FROM features" for p, f in zip(PRODUCTS, FLAGS)),
    "v12_explorer": "SELECT account_id, tier, industry, region, clv_12m, booking_count_90d, total_spend_90d, num_active_products, segment, "
                    "churn_risk_score, top_1_product FROM master WHERE tier IN ('Platinum', 'Gold') "
                    "AND regexp_matches(account_id::VARCHAR, '1') ORDER BY clv_12m DESC, account_id LIMIT 100",
    "v13_segment_breakdown": f"SELECT segment, {_SEG_AGG} FROM master WHERE segment IS NOT NULL GROUP BY segment",
    "v14_propensity_matrix": "SELECT account_id, clv_12m, " + ", ".join(f"s{i} AS \"{p}_score\"" for i, p in enumerate(PRODUCTS))
                             + " FROM (SELECT * FROM master ORDER BY clv_12m DESC, account_id LIMIT 50) JOIN probs USING (account_id)",
    "v15_top_recommendation_by_segment": """
SELECT segment, arg_min(top_1_product, ord) AS top_product, round(sum(s) / sum(k), 8) AS avg_score
FROM (SELECT segment, top_1_product, sum(top_1_score) AS s, count(top_1_score) AS k,
    row_number() OVER (PARTITION BY segment ORDER BY (top_1_product IS NULL), count(*) DESC, top_1_product) AS ord
  FROM master WHERE segment IS NOT NULL GROUP BY 1, 2) GROUP BY segment""",
    "v16_outreach_context": f"""
SELECT account_id, industry, tier AS clv_tier, format('${{:,.2f}}', round(clv_12m, 2)) AS clv_predicted, risk_level AS churn_risk_level,
  coalesce(held, 'None') AS current_products, coalesce(best, 'None') AS top_recommendation,
  format('Spend: ${{:,.2f}}, Bookings: {{}}, Support Tickets/Mo: {{}}', round(total_spend_90d, 2), booking_count_90d::BIGINT,
    round(ticket_rate_per_month, 2)::VARCHAR) AS recent_performance
FROM ({_PROFILE})
LEFT JOIN (SELECT account_id, string_agg(product, ', ' ORDER BY pos) AS held FROM scores WHERE label = 1 GROUP BY 1) USING (account_id)
LEFT JOIN (SELECT account_id, product AS best FROM offers WHERE r = 1) USING (account_id)""",
    # executive measures
    "b1_total_active_arr": "SELECT sum(contract_value)::DOUBLE AS total_active_arr FROM contracts WHERE is_active",
    "b2_predicted_churn_arr": "SELECT sum(arr)::DOUBLE AS predicted_churn_arr FROM arr WHERE account_id IN "
                              "(SELECT account_id FROM churn WHERE risk_level = 'High')",
    "b3_booking_run_rate": f"SELECT coalesce(sum(transaction_amount), 0)::DOUBLE AS booking_run_rate, count(*) AS bookings FROM fb "
                           f"WHERE booking_date > {CUT} - 30 AND booking_date <= {CUT}",
    "b4_churn_arr_decomposition": """
SELECT reg AS region, tr AS tier, ind AS industry, sum(arr)::DOUBLE AS churn_arr, count(*) AS accounts,
  grouping(reg, tr, ind) AS level
FROM arr JOIN acc USING (account_id) WHERE account_id IN (SELECT account_id FROM churn WHERE risk_level = 'High')
GROUP BY ROLLUP (reg, tr, ind)""",
    "b5_arr_and_pipeline_by_month": """
SELECT CAST(m AS VARCHAR) AS month, coalesce(sum(contract_value), 0)::DOUBLE AS active_arr, coalesce(max(pipe), 0) AS upsell_pipeline
FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2003-12-01', INTERVAL 1 MONTH))::DATE AS m) cal
LEFT JOIN contracts ON m BETWEEN start_date AND end_date
LEFT JOIN (SELECT date_trunc('month', expected_renewal_date)::DATE AS pm,
  round(sum((probability_score * base_acv)::DECIMAL(24,8))::DOUBLE, 4) AS pipe FROM xsell GROUP BY 1) ON pm = m
GROUP BY m""",
    "b6_top_churn_risks": "SELECT account_id, round(churn_risk_score, 6) AS churn_risk_score, risk_level, industry, tier FROM churn "
                          "ORDER BY churn.churn_risk_score DESC, account_id LIMIT 10",
    "b7_support_kpis": "SELECT sum(cost_proxy)::BIGINT AS total_support_cost, round(sum(coalesce(resolution_hours, 0))::DOUBLE / count(*), 6) AS avg_resolution_hours, "
                       "(SELECT count(*) FROM churn WHERE risk_level = 'High') AS high_risk_accounts FROM st",
    "b8_resolution_risk_quadrants": """
SELECT account_id, round(h, 6) AS avg_resolution_hours, round(churn_risk_score, 6) AS churn_risk_score, risk_level, base_acv,
  CASE WHEN h > mh AND churn_risk_score > mc THEN 'slow support, high risk' WHEN h > mh THEN 'slow support, low risk'
    WHEN churn_risk_score > mc THEN 'fast support, high risk' ELSE 'fast support, low risk' END AS quadrant
FROM (SELECT *, quantile_cont(h, 0.5) OVER () AS mh, quantile_cont(churn_risk_score, 0.5) OVER () AS mc
  FROM (SELECT account_id, sum(coalesce(resolution_hours, 0))::DOUBLE / count(*) AS h FROM st GROUP BY 1)
  JOIN churn USING (account_id) LEFT JOIN (SELECT account_id, base_acv FROM acc) USING (account_id))""",
    "b9_churn_influencers": """
SELECT factor, value, n AS accounts, round(pts::DOUBLE / n, 6) AS mean_score,
  round((total - pts)::DOUBLE / nullif(everyone - n, 0), 6) AS mean_score_rest,
  round(pts::DOUBLE / n - (total - pts)::DOUBLE / nullif(everyone - n, 0), 6) AS lift
FROM (SELECT factor, value, count(*) AS n, sum(p) AS pts FROM (
    SELECT account_id, 'industry' AS factor, ind AS value FROM acc UNION ALL SELECT account_id, 'region', reg FROM acc
    UNION ALL SELECT account_id, 'tier', tr FROM acc UNION (SELECT DISTINCT account_id, 'severity', severity FROM st))
  JOIN (SELECT account_id, churn_risk_score::DECIMAL(20,10) AS p FROM churn) USING (account_id) GROUP BY 1, 2),
  (SELECT sum(churn_risk_score::DECIMAL(20,10)) AS total, count(*) AS everyone FROM churn)""",
    "b10_weighted_pipeline": "SELECT round(sum((probability_score * estimated_gross_margin_pct)::DECIMAL(20,10))::DOUBLE, 4) AS weighted_pipeline "
                             "FROM xsell JOIN dim_products ON product_name = recommended_product",
    "b11_product_mix_by_industry": "SELECT industry, recommended_product, count(*) AS recommendations, "
                                   "count(*)::DOUBLE / (sum(count(*)) OVER (PARTITION BY industry))::DOUBLE AS share FROM xsell GROUP BY 1, 2",
    "b12_hit_list": "SELECT account_id, recommended_product, round(probability_score, 6) AS probability_score, company_name, "
                    "coalesce(arr, 0)::DOUBLE AS current_arr FROM xsell JOIN (SELECT account_id, company_name FROM accounts) USING (account_id) "
                    "LEFT JOIN arr USING (account_id) WHERE recommendation_rank = 1 AND xsell.probability_score > 0.8",
    "b13_out_of_policy_spend": """
SELECT account_id AS worst_account, s::DOUBLE AS worst_account_spend,
  (SELECT sum(transaction_amount) FROM fb WHERE is_out_of_policy)::DOUBLE AS out_of_policy_spend
FROM (SELECT account_id, sum(transaction_amount) AS s FROM fb WHERE is_out_of_policy AND account_id IS NOT NULL GROUP BY 1)
ORDER BY s DESC, account_id LIMIT 1""",
    "b14_out_of_policy_ribbon": """
SELECT CAST(month AS VARCHAR) AS month, industry, spend::DOUBLE AS spend, rk AS rank,
  lag(rk) OVER (PARTITION BY industry ORDER BY month) - rk AS rank_change
FROM (SELECT *, rank() OVER (PARTITION BY month ORDER BY spend DESC) AS rk
  FROM (SELECT date_trunc('month', booking_date)::DATE AS month, ind AS industry, sum(transaction_amount) AS spend
    FROM fb JOIN acc USING (account_id) WHERE is_out_of_policy GROUP BY 1, 2))""",
    "b15_out_of_policy_by_traveler_tier": """
SELECT CASE WHEN t.traveler_id IS NULL THEN 'Unknown' ELSE coalesce(nullif(travel_tier, ''), 'Standard') END AS travel_tier,
  sum(amount)::DOUBLE AS spend, count(*) AS bookings
FROM bookings b LEFT JOIN travelers t ON t.traveler_id = b.traveler_id WHERE is_out_of_policy GROUP BY 1""",
    "b16_ticket_timeline": "SELECT account_id, CAST(date_trunc('month', created_date)::DATE AS VARCHAR) AS month, count(*) AS tickets, "
                           "count(*) FILTER (WHERE severity IN ('P1', 'P2')) AS high_severity_tickets FROM st GROUP BY 1, 2",
    "b16_active_contracts": f"SELECT account_id, contract_id, product AS service_product, {text('start_date', 'end_date')}, "
                            "contract_value::DOUBLE AS contract_value FROM contracts WHERE is_active",
    "b16_policy_gauge": "SELECT account_id, count(*) AS bookings, round(count(*) FILTER (WHERE is_out_of_policy)::DOUBLE / count(*) * 100, 6) "
                        "AS out_of_policy_percent FROM sb WHERE account_id IS NOT NULL GROUP BY 1",
    # quality and alerts
    "q1_row_counts": _gate([(t, "min_rows", f"(SELECT count(*) FROM {t})", str(m), f"(SELECT count(*) FROM {t}) >= {m}")
                            for t, m in _MIN.items()]),
    "q3_null_keys": _gate([(t, "null_keys", f"(SELECT count(*) FROM {t} WHERE {k} IS NULL)", "0",
                            f"(SELECT count(*) FROM {t} WHERE {k} IS NULL) = 0") for t, k in _KEYS.items()]),
    "q4_feature_gate": _gate([
        ("account_features", "min_rows", "(SELECT count(*) FROM features)", "4500", "(SELECT count(*) FROM features) >= 4500"),
        ("account_features", "min_columns", "49", "30", "true"),
        ("account_features", "numeric_nulls", "0", "0", "true"),
        ("account_features", "target_present", "1", "1", "true")]),
    "q6_feature_statistics": _stats(NUMERIC),
    "a1_churn_alert": f"SELECT account_id, round(churn_risk_score, 6) AS churn_risk_score, risk_level, industry, tier, "
                      f"{text('expected_renewal_date')}, support_ticket_count FROM churn WHERE risk_level = 'High' "
                      "ORDER BY churn.churn_risk_score DESC, account_id LIMIT 5",
    "a2_alert_payloads": """
SELECT account_id, '{"account_id":"' || account_id || '","churn_score":' || churn_risk_score || ',"risk_level":"High","message":"URGENT: High Churn Risk Detected for Account '
  || account_id || '","action_required":"Create Retention Ticket"}' AS payload FROM churn WHERE risk_level = 'High'""",
    "a3_crm_opportunities": "SELECT account_id, recommendation_rank, recommended_product, round(probability_score, 6) AS probability_score, "
                            "'campaign_' || replace(replace(lower(recommended_product), ' ', '_'), '&', 'and') AS campaign_tag "
                            "FROM xsell WHERE xsell.probability_score > 0.5",
    "a4_outreach_candidates": "SELECT account_id, clv_12m, round(churn_risk_score, 6) AS churn_risk_score FROM features "
                              "JOIN (SELECT account_id, churn_risk_score FROM churn WHERE risk_level = 'High') USING (account_id) "
                              "WHERE NOT coalesce(is_churned, false) AND clv_12m >= (SELECT quantile_cont(clv_12m, 0.75) FROM features)",
    # streams and guards
    "t1_windowed_activity": """
SELECT account_id, CAST(ws AS VARCHAR) AS window_start, CAST(ws + INTERVAL 7 DAY AS VARCHAR) AS window_end, count(*) AS events,
  round(sum(value), 4) AS value, ws + INTERVAL 7 DAY > (SELECT max(ts) - INTERVAL 2 DAY FROM events) AS is_open
FROM (SELECT user_id AS account_id, value, unnest(generate_series(date_trunc('day', ts) - INTERVAL 6 DAY, date_trunc('day', ts), INTERVAL 1 DAY)) AS ws
  FROM events) GROUP BY account_id, ws""",
    "t2_activity_sessions": """
SELECT account_id, CAST(min(ts) AS VARCHAR) AS session_start, CAST(max(ts) + INTERVAL 12 HOUR AS VARCHAR) AS session_end, count(*) AS events,
  round(sum(value), 4) AS value, max(ts) + INTERVAL 12 HOUR > (SELECT max(ts) - INTERVAL 2 DAY FROM events) AS is_open
FROM (SELECT *, sum(fresh) OVER (PARTITION BY account_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM (SELECT user_id AS account_id, event_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
    <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM events))
GROUP BY account_id, sid""",
    "t4_winsorised_amounts": """
SELECT booking_id, traveler_id, CAST(booking_date AS VARCHAR) AS booking_date, round(least(amount::DOUBLE, top), 4) AS amount
FROM bookings, (SELECT quantile_cont(amount::DOUBLE, 0.99) AS top FROM bookings)""",
    "t5_score_drift": """
SELECT coalesce(a.bin, b.bin) AS bin, round(coalesce(e, 0), 8) AS expected, round(coalesce(f, 0), 8) AS actual,
  round((greatest(coalesce(f, 0), 1e-4) - greatest(coalesce(e, 0), 1e-4)) * ln(greatest(coalesce(f, 0), 1e-4) / greatest(coalesce(e, 0), 1e-4)), 8) AS stability
FROM (SELECT bin, n::DOUBLE / (sum(n) OVER ())::DOUBLE AS e FROM (SELECT least(9, floor(churn_risk_score * 10))::INT AS bin, count(*) AS n
  FROM churn_pred WHERE churn_risk_score IS NOT NULL GROUP BY 1)) a
FULL JOIN (SELECT bin, n::DOUBLE / (sum(n) OVER ())::DOUBLE AS f FROM (SELECT least(9, floor(churn_risk_score * 10))::INT AS bin, count(*) AS n
  FROM churn GROUP BY 1)) b ON a.bin = b.bin""",
}
# every feature column and which model may read it
_INPUTS = set(NUMERIC) - {"clv_12m"}
_SCHEMA_COLUMNS = ["tier", "region", "industry", "is_churned", "onboarding_date", *NUMERIC, "feature_timestamp"]
FINAL["f8_model_inputs"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c in NUMERIC} AS is_numeric, {c in _INPUTS} AS clv_input, "
    f"{c in _INPUTS - set(FLAGS)} AS cross_sell_input" for c in _SCHEMA_COLUMNS
)
FINAL["q2_required_columns"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'missing_columns:' AS check_name, 0 AS observed, 0 AS expected, true AS ok"
    for t in _KEYS
) + " UNION ALL SELECT 'clv_labels', 'missing_table', 0, 1, false"
_EARLIER = """
SELECT account_id FROM (SELECT account_id, coalesce(CASE WHEN account_id % 97 <> 0 THEN
    round(least(365, coalesce(days_since_last_booking, 365) - 60)::DOUBLE / 365, 4) END, 0)
  + (CASE ind WHEN 'Retail' THEN 0.35 WHEN 'Energy' THEN 0.25 WHEN 'Technology' THEN -0.15 WHEN 'Financial Services' THEN -0.20 ELSE 0 END)::DOUBLE
  + (CASE tr WHEN 'Platinum' THEN -0.15 WHEN 'Bronze' THEN 0.15 ELSE 0 END)::DOUBLE AS raw
  FROM acc LEFT JOIN rfm USING (account_id)) WHERE raw > 0.5"""
FINAL["b17_newly_high"] = f"""
SELECT account_id, tier, round(churn_risk_score, 6) AS churn_risk_score FROM churn
WHERE risk_level = 'High' AND account_id NOT IN ({_EARLIER})"""
FINAL["t3_first_alerts"] = f"""
SELECT account_id, 1 AS alerts FROM (SELECT account_id FROM churn WHERE risk_level = 'High' UNION {_EARLIER})"""
FINAL["t3b_cooled_alerts"] = FINAL["t3_first_alerts"].replace("1 AS alerts", "1::BIGINT AS alerts, 0::BIGINT AS late_rows", 1)
FINAL["s5b_loaded_rows"] = """
SELECT ticket_id::VARCHAR AS ticket_id, account_id::VARCHAR AS account_id, CAST(created_date::TIMESTAMP AS VARCHAR) AS created_date,
  CAST(resolved_date::TIMESTAMP AS VARCHAR) AS resolved_date, severity, category || chr(10) || '"' || severity || '"' AS category,
  resolution_hours::DOUBLE AS resolution_hours
FROM tickets WHERE ticket_id % 40 <> 7"""
FINAL["s7b_stored_features"] = FINAL["f6_assemble_features"]
FINAL["s8b_stored_probabilities"] = "SELECT account_id, " + ", ".join(
    f's{i} AS "{name}_score", c{i} AS "{name}_current"' for i, name in enumerate(PRODUCTS)) + " FROM probs"
FINAL["s9b_stored_bookings"] = FINAL["m5_fact_bookings"]
FINAL["s10_manifest"] = """
SELECT path, CASE path WHEN 'region.parquet' THEN 'changed' WHEN 'part.parquet' THEN 'new' WHEN 'gone.parquet' THEN 'missing' ELSE 'ok' END AS status
FROM (SELECT unnest(string_split('region nation customer supplier part orders lineitem events documents embeddings pages benchmark '
  || 'labels conversations gone', ' ')) || '.parquet' AS path)"""
FINAL["v3b_account_page_after"] = FINAL["v3_account_page"].replace("ORDER BY account_id LIMIT 50 OFFSET 20", "") + (
    " QUALIFY account_id > 60 ORDER BY account_id LIMIT 50")
FINAL["x2b_classifier_invariants"] = """
SELECT product, count(*) AS accounts, sum(label)::BIGINT AS current, true AS probabilities FROM scores GROUP BY product"""
FINAL["x1_adoption_rates"] = """
SELECT * FROM (""" + FINAL["x1_adoption_rates"].replace("FROM x GROUP", """FROM (
  SELECT *, CASE WHEN share < 0.8 THEN 'train' ELSE 'test' END AS split FROM (SELECT *,
    (row_number() OVER (ORDER BY ('0x' || substr(md5('cross-sell:' || account_id), 1, 8))::BIGINT) - 1) / (count(*) OVER ())::DOUBLE AS share
    FROM features)) GROUP""") + ")"

# one column family at a time: key -> (family, columns)
SINGLE_FEATURES: dict[str, tuple[str, list[str]]] = {
    "f1a_booking_counts": ("rfm", [f"booking_count_{w}d" for w in (30, 90, 180)]),
    "f1b_total_spend": ("rfm", [f"total_spend_{w}d" for w in (30, 90, 180)]),
    "f1c_avg_booking_amount": ("rfm", [f"avg_booking_amount_{w}d" for w in (30, 90, 180)]),
    "f1d_days_since_last_booking": ("rfm", ["days_since_last_booking"]),
    "f1e_lifetime_totals": ("rfm", ["total_booking_count", "total_spend"]),
    "f2a_booking_volume_trend": ("traj", ["booking_volume_trend"]),
    "f2b_spend_trend": ("traj", ["spend_trend"]),
    "f2c_spend_acceleration": ("traj", ["spend_acceleration"]),
    "f2d_cancellation_rates": ("traj", ["cancellation_rate_30d", "cancellation_rate_90d"]),
    "f3a_num_active_products": ("svc", ["num_active_products"]),
    "f3b_product_diversity": ("svc", ["product_diversity_score"]),
    "f3c_active_contract_value": ("svc", ["active_contract_value"]),
    "f3d_contract_renewals": ("svc", ["contract_renewal_count"]),
    "f3e_product_flags": ("svc", list(FLAGS)),
    "f4a_ticket_totals": ("sup", ["total_ticket_count", "avg_resolution_hours"]),
    "f4b_ticket_rate": ("sup", ["ticket_rate_per_month"]),
    "f4c_escalation_ratio": ("sup", ["p1_p2_escalation_ratio"]),
    "f4d_recent_tickets": ("sup", ["ticket_count_90d"]),
    "f4e_ticket_trend": ("sup", ["ticket_trend_ratio"]),
    "f4f_severe_resolution": ("sup", ["avg_severe_resolution_hours"]),
    "f4g_category_concentration": ("sup", ["ticket_category_concentration"]),
    "f5a_out_of_policy_rates": ("pol", ["out_of_policy_rate_30d", "out_of_policy_rate_90d"]),
    "f5b_oop_trend": ("pol", ["oop_trend"]),
    "f5c_destination_diversity": ("pol", ["destination_diversity"]),
    "f5d_lead_time": ("pol", ["avg_lead_time_days"]),
}
FINAL |= {key: per_account(family, cols) for key, (family, cols) in SINGLE_FEATURES.items()}


def all_statements() -> dict[str, str]:
    return {key: statement(sql) for key, sql in FINAL.items()}
