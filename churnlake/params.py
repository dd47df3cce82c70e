"""Job parameters.  Nothing here is a module constant of the jobs: every
operator takes the values it needs as arguments, these are the defaults."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # Snapshot that separates the observed past from the label window.
    snapshot: dt.datetime = dt.datetime(2001, 6, 1)
    label_days: int = 30                 # churn label horizon
    recent_days: int = 30                # orders_last_30_days window
    seed: int = 42
    # Defaults used by cleaning.
    default_city: str = "Unknown"
    default_diet: str = "balanced"
    default_delivery_hour: str = "afternoon"
    default_meal_plan: str = "weekly_classic"
    default_status: str = "active"
    default_end_days: int = 30
    # Age bins, right-closed: (0,25] (25,35] (35,50] (50,100]
    age_edges: tuple = (0, 25, 35, 50, 100)
    # Time bucket used to split a user's ordered history before `lag`
    # windows, so one heavy user is spread over many tasks.
    history_bucket_days: int = 7
    # Drift.
    ks_pvalue_threshold: float = 0.05
    psi_threshold: float = 0.2
    drift_warning_share: float = 0.15
    drift_critical_share: float = 0.30
    psi_bins: int = 10
    categorical_max_distinct: int = 5
    min_samples: int = 5
    # Scoring.
    risk_low_factor: float = 0.5
    risk_high_factor: float = 1.5

    @property
    def label_end(self) -> dt.datetime:
        return self.snapshot + dt.timedelta(days=self.label_days)

    @property
    def recent_start(self) -> dt.datetime:
        return self.snapshot - dt.timedelta(days=self.recent_days)


# The 17 model features, in the trained order (fixed values).
FEATURES = [
    "days_since_last_order", "tenure_days", "total_orders",
    "std_days_between_orders", "orders_last_30_days", "avg_order_value",
    "avg_rating", "coupon_usage_count", "coupon_usage_rate", "monthly_price",
    "subscription_tenure_days", "n_plan_changes", "avg_app_logins",
    "avg_meals_skipped", "total_support_tickets", "age", "age_group_code",
]

# Imputation defaults of the feature matrix (fixed values): 999 for recency,
# 30 for age, 0 for every other column.
IMPUTE_DEFAULTS = {"days_since_last_order": 999, "age": 30}

# One-hot vocabularies of the published feature table (fixed values).
DIET_VALUES = ["balanced", "keto", "low_carb", "mediterranean", "paleo", "vegan"]
REFERRAL_VALUES = ["blog", "direct", "facebook", "friend", "google", "instagram", "tiktok"]

# Drift monitoring list (fixed values).  Four of these names are not in the
# 17-feature matrix; the report only uses columns present on both sides.
MONITORED_FEATURES = [
    "days_since_last_order", "total_orders", "total_spent", "avg_order_value",
    "avg_rating", "total_support_tickets", "is_sub_active", "avg_app_logins",
    "login_decline", "order_frequency_per_month", "subscription_tenure_days",
    "tenure_days",
]
