"""Landing-zone path layout: ``<root>/raw/<entity>/dt=<YYYY-MM-DD>/<file>``.

The ``dt=`` segment is Hive-style, so reading ``<root>/raw/<entity>`` picks
every landed day up with ``dt`` as a date column (partition discovery).
"""

from __future__ import annotations

import datetime as _dt

# The landing layout and file names of the three entities.
LANDING_PREFIX = "raw"
ENTITY_FILES = {
    "customers": "customers.csv",
    "products": "products.csv",
    "orders": "orders.csv",
}


def _check_day(dt: str) -> str:
    return _dt.date.fromisoformat(str(dt)).isoformat()


def landing_dir(root: str, entity: str, dt: str | None = None) -> str:
    base = f"{root.rstrip('/')}/{LANDING_PREFIX}/{entity}"
    return base if dt is None else f"{base}/dt={_check_day(dt)}"


def raw_entity_path(bucket: str, entity: str, dt: str, filename: str, scheme: str = "s3") -> str:
    root = f"{scheme}://{bucket}" if scheme else bucket
    return f"{landing_dir(root, entity, dt)}/{filename}"


def raw_customers_path(bucket: str, dt: str, scheme: str = "s3") -> str:
    return raw_entity_path(bucket, "customers", dt, ENTITY_FILES["customers"], scheme)


def raw_products_path(bucket: str, dt: str, scheme: str = "s3") -> str:
    return raw_entity_path(bucket, "products", dt, ENTITY_FILES["products"], scheme)


def raw_orders_path(bucket: str, dt: str, scheme: str = "s3") -> str:
    return raw_entity_path(bucket, "orders", dt, ENTITY_FILES["orders"], scheme)
