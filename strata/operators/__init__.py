"""Pure DataFrame -> DataFrame transforms of the three layers."""

from strata.operators.dedupe import dedupe_by_key, latest_per_key
from strata.operators.facts import order_amount, transform_fact_orders
from strata.operators.history import scd2_history
from strata.operators.marts import build_daily_product_sales, enrich_sales, top_sales
from strata.operators.scd2 import (
    Scd2Result,
    add_hash_diff,
    scd2_apply,
    scd2_plan,
    scd2_plan_sql,
    split_dimension,
    stage_source,
)
from strata.operators.standardize import (
    standardize_customers,
    standardize_orders,
    standardize_products,
)

__all__ = [
    "Scd2Result",
    "add_hash_diff",
    "build_daily_product_sales",
    "dedupe_by_key",
    "enrich_sales",
    "latest_per_key",
    "order_amount",
    "scd2_apply",
    "scd2_history",
    "scd2_plan",
    "scd2_plan_sql",
    "split_dimension",
    "stage_source",
    "standardize_customers",
    "standardize_orders",
    "standardize_products",
    "top_sales",
    "transform_fact_orders",
]
