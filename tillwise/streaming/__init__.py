from tillwise.streaming.clicks import (
    abandoned_carts,
    abandoned_sessions,
    last_views_before_purchase,
    sales_after_page,
    seen_in_session_with,
    session_totals,
    sessionize,
)

__all__ = [
    "abandoned_carts",
    "abandoned_sessions",
    "last_views_before_purchase",
    "sales_after_page",
    "seen_in_session_with",
    "session_totals",
    "sessionize",
]
