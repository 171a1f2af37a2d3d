"""Bronze standardization of raw landing snapshots (all columns text).

Trim text, lower-case email, parse numbers and timestamps tolerantly, drop
rows without a key (and orders without a positive quantity), then stamp the
business date ``dt`` and the processing instant ``ingest_ts``.  Narrow
transforms only: no shuffle, runs in one codegen stage per scan split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import parse_double, parse_int, parse_timestamp
from strata.operators._common import Day, RunTs, day_col, run_ts_col, valid_key


def _trimmed(name: str):
    return F.trim(F.col(name)).alias(name)


def standardize_customers(raw: DataFrame, dt: Day = None, run_ts: RunTs = None) -> DataFrame:
    return raw.select(
        _trimmed("customer_id"),
        _trimmed("full_name"),
        F.lower(F.trim(F.col("email"))).alias("email"),
        _trimmed("city"),
        parse_timestamp("updated_at").alias("updated_at"),
        day_col(dt).alias("dt"),
        run_ts_col(run_ts).alias("ingest_ts"),
    ).where(valid_key("customer_id"))


def standardize_products(raw: DataFrame, dt: Day = None, run_ts: RunTs = None) -> DataFrame:
    return raw.select(
        _trimmed("product_id"),
        _trimmed("product_name"),
        _trimmed("category"),
        parse_double("list_price").alias("list_price"),
        parse_timestamp("updated_at").alias("updated_at"),
        day_col(dt).alias("dt"),
        run_ts_col(run_ts).alias("ingest_ts"),
    ).where(valid_key("product_id"))


def standardize_orders(raw: DataFrame, dt: Day = None, run_ts: RunTs = None) -> DataFrame:
    return raw.select(
        _trimmed("order_id"),
        parse_timestamp("order_ts").alias("order_ts"),
        _trimmed("customer_id"),
        _trimmed("product_id"),
        parse_int("quantity").alias("quantity"),
        parse_double("unit_price").alias("unit_price"),
        day_col(dt).alias("dt"),
        run_ts_col(run_ts).alias("ingest_ts"),
    ).where(valid_key("order_id") & (F.col("quantity") > 0))
