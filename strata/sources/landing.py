"""CSV landing snapshots.

Read with a header and no schema, then select the expected columns by
name: a user schema would bind by position and silently mislabel a file
whose columns were reordered; a missing column fails at analysis instead.
Over many files Spark takes the names from one file's header and binds the
others by position, so ``enforceSchema=false`` is set: each file's header is
checked against those names and a file with reordered columns fails the read
instead of loading mislabelled values.
Permissive mode (the default): short rows give nulls, extra fields drop,
blank and quoted-blank fields read as null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import RAW_CUSTOMER_COLUMNS, RAW_ORDER_COLUMNS, RAW_PRODUCT_COLUMNS
from strata.sources.paths import landing_dir

RAW_COLUMNS = {
    "customers": RAW_CUSTOMER_COLUMNS,
    "products": RAW_PRODUCT_COLUMNS,
    "orders": RAW_ORDER_COLUMNS,
}


def read_landing(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One landed file or folder, all columns as text, bound by header name."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])


def read_landing_days(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Every landed day of ``entity``; ``dt`` comes from the folder names
    and filters on it prune folders before any file is opened."""
    path = landing_dir(root, entity)
    raw = spark.read.option("header", True).option("enforceSchema", False).option("basePath", path).csv(path)
    cols = RAW_COLUMNS[entity]
    return raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols], F.col("dt").cast("date"))
