"""Retention texts.

FIXED VALUES: the texts below must equal the reference's word for word, so
they are stated plainly, in the reference's order.  ``signal`` holds one
Python format field ``{value:...}`` that is rendered per row.
"""

from __future__ import annotations

# --- fixed values: feature -> label / signal / action / strength action ---
FEATURE_TEXTS = {
    "days_since_last_order": (
        "Days since last order",
        "Hasn't ordered in {value:.0f} days — disengagement signal",
        "Send personalized re-engagement offer with free delivery on next order",
        "Recently ordered — maintain engagement with loyalty rewards"),
    "tenure_days": (
        "Account tenure",
        "Short account history of only {value:.0f} days — low loyalty",
        "Welcome series: offer a discounted 4-week trial to build ordering habit",
        "Long-tenured user — leverage loyalty with VIP perks"),
    "total_orders": (
        "Total orders",
        "Only {value:.0f} total orders placed — low engagement",
        "Offer a 'complete 5 more orders for a free box' incentive",
        "High order volume — recognize with a loyalty badge"),
    "orders_last_30_days": (
        "Orders in last 30 days",
        "Only {value:.0f} orders in the last month — declining activity",
        "Send 'We miss you' email with a free meal upgrade on next order",
        "Recently active — encourage with referral bonus"),
    "avg_order_value": (
        "Average order value",
        "Low average order value of ${value:.2f} — bargain-seeking behavior",
        "Upsell with premium meal bundles or add-on items",
        "High-value customer — offer exclusive tasting menu preview"),
    "avg_rating": (
        "Average rating",
        "Average rating of {value:.1f}/5 — below satisfaction threshold",
        "Schedule a call with a meal planner to address recipe preferences",
        "High ratings — leverage as brand advocate (request review)"),
    "coupon_usage_count": (
        "Coupon usage count",
        "Used coupons {value:.0f} times — price-sensitive behavior",
        "Offer a subscription discount to lock in commitment",
        "Price-insensitive — focus on quality/premium messaging"),
    "coupon_usage_rate": (
        "Coupon usage rate",
        "{value:.0%} of orders used coupons — deal-dependent",
        "Convert to annual subscription with locked-in rate",
        "Low coupon reliance — stable revenue stream"),
    "n_plan_changes": (
        "Plan changes",
        "Changed plans {value:.0f} times — indecision or dissatisfaction",
        "Offer a personalized meal assessment to find the right plan fit",
        "Stable plan — user is satisfied with current offering"),
    "monthly_price": (
        "Monthly price",
        "Spending ${value:.2f}/month — high price sensitivity risk",
        "Check if pricing aligns with perceived value; offer mid-tier alternative",
        "Premium subscriber — ensure VIP service level"),
    "subscription_tenure_days": (
        "Subscription tenure",
        "Only {value:.0f} days subscribed — early churn risk window",
        "Strengthen onboarding with guided meal selection and tips",
        "Long-term subscriber — recognize milestone with a reward"),
    "avg_app_logins": (
        "App logins per week",
        "Only {value:.1f} app logins per week — app disengagement",
        "Send push notification with a surprise reward to re-engage",
        "Frequent app user — leverage app for exclusive offers"),
    "avg_meals_skipped": (
        "Meals skipped per week",
        "Skipping {value:.1f} meals per week — meal fatigue or dissatisfaction",
        "Offer menu customization consultation to refresh meal choices",
        "Low skip rate — meal plans are well-matched"),
    "total_support_tickets": (
        "Support tickets",
        "Filed {value:.0f} support tickets — unresolved issues likely",
        "Prioritize resolving all open tickets; offer goodwill credit",
        "No support issues — satisfied customer experience"),
    "age": (
        "Age",
        "Age {value:.0f} — may need tailored meal offerings",
        "Offer age-relevant meal plans (e.g., senior-friendly options)",
        "Demographic profile is well-served — maintain targeting"),
    "age_group_code": (
        "Age group",
        "Age group may need different communication style",
        "Adjust marketing channel to match age group preferences",
        "Age group well-engaged — continue current approach"),
    "std_days_between_orders": (
        "Order consistency",
        "Irregular ordering pattern (std dev {value:.1f} days) — unpredictable",
        "Offer a recurring subscription incentive to regularize order cadence",
        "Consistent ordering pattern — reliable engagement"),
}

# --- fixed values: sentence parts and fallbacks ---
LOW_STRENGTH = "Low risk (P={p}). User is in good standing — no retention action needed. Strength: {s}."
LOW_FALLBACK = "Low risk (P={p}). No action needed. User shows healthy engagement patterns."
MEDIUM_BASE = "At-risk (P={p}). Recommend proactive retention:"
MEDIUM_SIGNALS = "At-risk (P={p}). Signals: {s}."
MEDIUM_FALLBACK_ACTIONS = ["Send a re-engagement email with a personalized discount",
                           "Offer a free recipe consultation"]
HIGH_BASE = "⚠ HIGH CHURN RISK (P={p}). Immediate retention action required."
HIGH_FALLBACK_ACTIONS = ["Call or SMS the user with a personalized win-back offer",
                         "Offer a free week trial with new menu rotation",
                         "Survey the user to understand specific dissatisfaction reasons",
                         "Assign a dedicated meal planner to address dietary concerns"]
SIGNAL_MIN_IMPACT = 0.001
