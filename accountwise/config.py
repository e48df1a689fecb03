"""Fixed business values and the default parameters of the jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# --- fixed values: they must equal those of the source system -----------------
PRODUCTS = ("Neo", "Egencia Analytics Studio", "Meetings & Events", "Travel Consulting")
TIER_RANK = {"Platinum": 4, "Gold": 3, "Silver": 2, "Bronze": 1}
SEVERITY_COST = {"P1": 2000, "P2": 500, "P3": 150, "P4": 50}
SEVERE = ("P1", "P2")
PRODUCT_CATEGORY = {
    "Neo": "Travel Booking Platform",
    "Egencia Analytics Studio": "Data & Insights",
    "Meetings & Events": "Event Management",
    "Travel Consulting": "Professional Services",
}
PRODUCT_MARGIN = {
    "Neo": 0.65,
    "Egencia Analytics Studio": 0.85,
    "Meetings & Events": 0.25,
    "Travel Consulting": 0.45,
}
CHURN_BIAS_BY_INDUSTRY = {"Retail": 0.35, "Energy": 0.25, "Technology": -0.15, "Financial Services": -0.20}
CHURN_BIAS_BY_TIER = {"Platinum": -0.15, "Bronze": 0.15}
UPSELL_BIAS_BY_INDUSTRY_PRODUCT = {
    ("Technology", "Egencia Analytics Studio"): 0.25,
    ("Financial Services", "Meetings & Events"): 0.20,
    ("Energy", "Neo"): 0.15,
}
UPSELL_BIAS_BY_TIER = {"Platinum": 0.15, "Gold": 0.05}
HIGH_RISK, MEDIUM_RISK = 0.5, 0.25
OPEN_END = date(9999, 12, 31)
NULL_TOKENS = ("", "None", "NaT")
SENSITIVE_NAME_PARTS = ("clv", "amount", "spend", "revenue", "contract_value", "acv")
SURVIVAL_HORIZONS = (30, 90, 180, 365)

SURVIVAL_COVARIATES = (
    "tier_rank", "tenure_days", "annual_contract_value", "booking_count_90d", "total_spend_90d",
    "booking_volume_trend", "spend_acceleration", "cancellation_rate_90d", "num_active_products",
    "ticket_rate_per_month", "p1_p2_escalation_ratio", "out_of_policy_rate_90d", "avg_resolution_hours",
    "destination_diversity",
)
SEGMENT_FEATURES = (
    "tier_rank", "annual_contract_value", "tenure_days", "booking_count_90d", "total_spend_90d",
    "booking_volume_trend", "spend_acceleration", "cancellation_rate_90d", "num_active_products",
    "ticket_rate_per_month", "p1_p2_escalation_ratio", "out_of_policy_rate_90d", "clv_12m",
)
MODEL_EXCLUDED = ("account_id", "tier", "region", "industry", "is_churned", "clv_12m", "feature_timestamp")

MIN_ROWS = {
    "accounts": 4500, "bookings": 800_000, "travelers": 20_000,
    "contracts": 5_000, "tickets": 10_000, "clv_labels": 4500,
}
PRIMARY_KEY = {
    "accounts": "account_id", "bookings": "booking_id", "travelers": "traveler_id",
    "contracts": "contract_id", "tickets": "ticket_id", "clv_labels": "account_id",
}
REQUIRED_COLUMNS = {
    "accounts": ("account_id", "tier", "is_churned"),
    "bookings": ("booking_id", "amount", "booking_date"),
    "travelers": ("traveler_id", "account_id"),
    "contracts": ("contract_id", "product"),
    "tickets": ("ticket_id", "severity"),
    "clv_labels": ("account_id", "clv_12m"),
}
# --- end of fixed values -------------------------------------------------------


def product_slug(product: str) -> str:
    return product.lower().replace(" ", "_").replace("&", "and")


PRODUCT_FLAGS = {p: f"has_{product_slug(p)}" for p in PRODUCTS}


@dataclass(frozen=True)
class Params:
    """When "now" is, and how far the feature windows reach back."""

    cutoff: date = date(2023, 1, 1)
    as_of: date = date(2024, 12, 31)
    windows: tuple[int, ...] = (30, 90, 180)
    rate_windows: tuple[int, ...] = (30, 90)
    label_days: int = 365

    def back(self, days: int) -> date:
        return self.cutoff - timedelta(days=days)

    def ahead(self, days: int) -> date:
        return self.cutoff + timedelta(days=days)
