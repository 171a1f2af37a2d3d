"""strata: a Spark-native Bronze -> Silver -> Gold lakehouse ETL.

Every transform is a pure ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; only the sinks know about storage.  See README.md
for the module map.
"""

from strata.functions import (
    change_hash,
    parse_double,
    parse_int,
    parse_timestamp,
    previous_business_date,
)
from strata.operators import (
    add_hash_diff,
    build_daily_product_sales,
    latest_per_key,
    scd2_apply,
    scd2_plan,
    standardize_customers,
    standardize_orders,
    standardize_products,
    top_sales,
    transform_fact_orders,
)

__all__ = [
    "add_hash_diff",
    "build_daily_product_sales",
    "change_hash",
    "latest_per_key",
    "parse_double",
    "parse_int",
    "parse_timestamp",
    "previous_business_date",
    "scd2_apply",
    "scd2_plan",
    "standardize_customers",
    "standardize_orders",
    "standardize_products",
    "top_sales",
    "transform_fact_orders",
]
