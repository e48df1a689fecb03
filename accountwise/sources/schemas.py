"""Schemas of the raw tables, as DDL."""

RAW = {
    "corporate_accounts": (
        "account_id string, company_name string, industry string, region string, tier string, "
        "onboarding_date date, is_churned boolean, churn_date date, annual_contract_value decimal(12,2)"
    ),
    "service_contracts": (
        "contract_id string, account_id string, product string, start_date date, end_date date, "
        "contract_value decimal(12,2), is_active boolean"
    ),
    "traveler_profiles": "traveler_id string, account_id string, role string, travel_tier string",
    "bookings": (
        "booking_id string, traveler_id string, booking_type string, booking_date date, travel_date date, "
        "amount decimal(10,2), is_out_of_policy boolean, is_cancelled boolean, destination_region string"
    ),
    "support_tickets": (
        "ticket_id string, account_id string, created_date timestamp_ntz, resolved_date timestamp_ntz, "
        "severity string, category string, resolution_hours decimal(8,2)"
    ),
    "clv_labels": (
        "account_id string, booking_revenue_12m decimal(12,2), contract_value_active decimal(12,2), "
        "support_cost_12m decimal(12,2), clv_12m decimal(12,2)"
    ),
    "churn_predictions": (
        "account_id string, survival_prob_30d double, survival_prob_90d double, survival_prob_180d double, "
        "survival_prob_365d double, churn_risk_score double, partial_hazard double, expected_lifetime_days double"
    ),
    "cross_sell_recommendations": (
        "account_id string, top_1_product string, top_1_score double, top_2_product string, top_2_score double, "
        "num_products_current int"
    ),
}
LOGICAL_NAME = {
    "corporate_accounts": "accounts", "service_contracts": "contracts", "traveler_profiles": "travelers",
    "bookings": "bookings", "support_tickets": "tickets", "clv_labels": "clv_labels",
    "churn_predictions": "churn_predictions", "cross_sell_recommendations": "recommendations",
}
ENTITY_TABLES = (
    "corporate_accounts", "traveler_profiles", "bookings", "service_contracts", "support_tickets", "clv_labels",
)
PREDICTIONS = ("churn_predictions", "cross_sell_recommendations")
NAMESPACES = ("raw", "staging", "features")
