"""Readers: landing paths and CSV snapshots, stored-table scans."""

from strata.sources.landing import read_landing, read_landing_days
from strata.sources.paths import (
    landing_dir,
    raw_customers_path,
    raw_entity_path,
    raw_orders_path,
    raw_products_path,
)
from strata.sources.tables import read_current, read_day, read_table

__all__ = [
    "landing_dir",
    "raw_customers_path",
    "raw_entity_path",
    "raw_orders_path",
    "raw_products_path",
    "read_current",
    "read_day",
    "read_landing",
    "read_landing_days",
    "read_table",
]
