from lakeload.plans.jobs import (
    PRODUCTS_PATTERNS,
    PRODUCTS_STATS,
    USERS_PATTERNS,
    USERS_STATS,
    daily_load,
    refresh_and_profile,
    refresh_products,
    refresh_users,
)

__all__ = [
    "PRODUCTS_PATTERNS",
    "PRODUCTS_STATS",
    "USERS_PATTERNS",
    "USERS_STATS",
    "daily_load",
    "refresh_and_profile",
    "refresh_products",
    "refresh_users",
]
