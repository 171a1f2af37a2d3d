"""Logical schemas of the raw landing files and the seven stored tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw CSV header names and the timestamp text format of the
# landing zone.  These must equal the upstream producer's files.
RAW_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
RAW_CUSTOMER_COLUMNS = ("customer_id", "full_name", "email", "city", "updated_at")
RAW_PRODUCT_COLUMNS = ("product_id", "product_name", "category", "list_price", "updated_at")
RAW_ORDER_COLUMNS = ("order_id", "order_ts", "customer_id", "product_id", "quantity", "unit_price")

AMOUNT = DecimalType(18, 2)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


def raw_schema(columns: tuple[str, ...]) -> StructType:
    """Landing files carry text only; typing happens in standardize."""
    return _struct(*[(c, StringType()) for c in columns])


CUSTOMERS_STG = _struct(
    ("customer_id", StringType()),
    ("full_name", StringType()),
    ("email", StringType()),
    ("city", StringType()),
    ("updated_at", TimestampType()),
    ("dt", DateType()),
    ("ingest_ts", TimestampType()),
)

PRODUCTS_STG = _struct(
    ("product_id", StringType()),
    ("product_name", StringType()),
    ("category", StringType()),
    ("list_price", DoubleType()),
    ("updated_at", TimestampType()),
    ("dt", DateType()),
    ("ingest_ts", TimestampType()),
)

ORDERS_STG = _struct(
    ("order_id", StringType()),
    ("order_ts", TimestampType()),
    ("customer_id", StringType()),
    ("product_id", StringType()),
    ("quantity", IntegerType()),
    ("unit_price", DoubleType()),
    ("dt", DateType()),
    ("ingest_ts", TimestampType()),
)

_SCD2_TAIL = (
    ("hash_diff", StringType()),
    ("effective_from_ts", TimestampType()),
    ("effective_to_ts", TimestampType()),
    ("is_current", BooleanType()),
    ("ingest_ts", TimestampType()),
)

DIM_CUSTOMER = _struct(
    ("customer_id", StringType()),
    ("full_name", StringType()),
    ("email", StringType()),
    ("city", StringType()),
    *_SCD2_TAIL,
)

DIM_PRODUCT = _struct(
    ("product_id", StringType()),
    ("product_name", StringType()),
    ("category", StringType()),
    ("list_price", DoubleType()),
    *_SCD2_TAIL,
)

FACT_ORDERS = _struct(
    ("order_id", StringType()),
    ("order_ts", TimestampType()),
    ("customer_id", StringType()),
    ("product_id", StringType()),
    ("quantity", IntegerType()),
    ("unit_price", DoubleType()),
    ("order_amount", AMOUNT),
    ("dt", DateType()),
    ("ingest_ts", TimestampType()),
)

DAILY_PRODUCT_SALES = _struct(
    ("dt", DateType()),
    ("product_id", StringType()),
    ("category", StringType()),
    ("orders_count", LongType()),
    ("units_sold", LongType()),
    ("gross_revenue", AMOUNT),
    ("unique_customers", LongType()),
    ("ingest_ts", TimestampType()),
)

# Dimension definitions: key, tracked (hashed) columns, recency order.
CUSTOMER_DIM_SPEC = {
    "key": "customer_id",
    "tracked": ("full_name", "email", "city"),
    "order": ("updated_at", "ingest_ts"),
}
PRODUCT_DIM_SPEC = {
    "key": "product_id",
    "tracked": ("product_name", "category", "list_price"),
    "order": ("updated_at", "ingest_ts"),
}
