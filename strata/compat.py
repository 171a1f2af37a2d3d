"""Entry points under the names the original job collection used, so jobs
written against it run here unchanged apart from the storage root.

``transform_*`` are the bronze standardizers, ``scd2_merge`` merges into a
stored dimension (path-based; pass ``root`` and the run's ``dt``), and
``compute_yesterday_dt`` is the previous business date of an instant.
"""

from __future__ import annotations

import datetime as _dt

from strata.functions.calendar import BUSINESS_TZ
from strata.operators import (
    add_hash_diff,
    build_daily_product_sales,
    latest_per_key,
    standardize_customers,
    standardize_orders,
    standardize_products,
    transform_fact_orders,
)
from strata.plans.daily import run_day, scd2_merge
from strata.sources.paths import raw_customers_path, raw_entity_path, raw_orders_path, raw_products_path

transform_customers = standardize_customers
transform_products = standardize_products
transform_orders = standardize_orders


def compute_yesterday_dt(now: _dt.datetime | None = None, tz: str = BUSINESS_TZ) -> dict[str, str]:
    """``{"dt": "YYYY-MM-DD"}``: the day before today in ``tz`` (driver-side
    helper for choosing a run date; a naive ``now`` is taken as UTC)."""
    from zoneinfo import ZoneInfo

    now = now or _dt.datetime.now(_dt.timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=_dt.timezone.utc)
    return {"dt": (now.astimezone(ZoneInfo(tz)).date() - _dt.timedelta(days=1)).isoformat()}


__all__ = [
    "add_hash_diff",
    "build_daily_product_sales",
    "compute_yesterday_dt",
    "latest_per_key",
    "raw_customers_path",
    "raw_entity_path",
    "raw_orders_path",
    "raw_products_path",
    "run_day",
    "scd2_merge",
    "transform_customers",
    "transform_fact_orders",
    "transform_orders",
    "transform_products",
]
