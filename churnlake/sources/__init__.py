from churnlake.sources.tables import load_table, load_tables
from churnlake.sources.adapters import (
    raw_users, raw_orders, raw_subscriptions, raw_engagement, request_log,
    scored_rows, drift_sides,
)

__all__ = [
    "load_table", "load_tables", "raw_users", "raw_orders", "raw_subscriptions",
    "raw_engagement", "request_log", "scored_rows", "drift_sides",
]
