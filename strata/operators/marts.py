"""Gold: daily product sales and its preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators._common import RunTs, run_ts_col
from strata.schemas import AMOUNT


def enrich_sales(fact: DataFrame, dim_product_current: DataFrame) -> DataFrame:
    """Fact rows with the category of the product's current dimension row
    (left join on ``product_id``; no dimension row -> null category)."""
    return fact.join(dim_product_current.select("product_id", "category"), "product_id", "left")


def build_daily_product_sales(
    fact_orders: DataFrame, dim_product_current: DataFrame, run_ts: RunTs = None, unique_orders: bool = False
) -> DataFrame:
    """Per ``(dt, product_id, category)``: distinct orders, units, revenue
    rounded to decimal(18,2), distinct customers.

    Result-equal to "left join the current dimension, then group by", but
    planned as aggregate-then-join: the fact is reduced to one row per
    ``(dt, product_id)`` (partial aggregation map-side, so a product holding a
    third of all orders is pre-combined before it is shuffled), and only that
    small result meets the dimension.  The dimension is folded to one row per
    ``(product_id, category)`` with its number of copies, so the join gives the
    mart's rows as they are and no hash table of them is built after it.  If
    the dimension ever held two current rows for a product, sums double while
    distinct counts do not, exactly as with join-first.

    ``unique_orders`` declares that an order_id occurs once a day in the fact,
    as :func:`transform_fact_orders` leaves it.  Orders are then counted
    without looking for repeats and the customers' distinct count alone takes
    the two levels of aggregation that Spark gives a single one: no row is
    copied for it, where two distinct counts copy each row three times before
    the first shuffle.
    """
    orders = F.count("order_id") if unique_orders else F.countDistinct("order_id")
    per_product = fact_orders.groupBy("dt", "product_id").agg(
        orders.alias("orders_count"),
        F.sum("quantity").alias("_units"),
        F.sum("order_amount").alias("_revenue"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    categories = dim_product_current.groupBy("product_id", "category").agg(F.count("*").alias("_n"))
    copies = F.coalesce("_n", F.lit(1))
    return per_product.join(categories, "product_id", "left").select(
        "dt",
        "product_id",
        "category",
        "orders_count",
        (F.col("_units") * copies).cast("bigint").alias("units_sold"),
        F.round(F.col("_revenue") * copies, 2).try_cast(AMOUNT).alias("gross_revenue"),
        "unique_customers",
        run_ts_col(run_ts).alias("ingest_ts"),
    )


def top_sales(sales: DataFrame, n: int = 50) -> DataFrame:
    """Latest days first, ``n`` rows; ties broken by product and category so
    the preview is reproducible (a bounded top-k, planned as
    ``TakeOrderedAndProject``)."""
    return sales.orderBy(
        F.col("dt").desc_nulls_last(),
        F.col("product_id").asc_nulls_last(),
        F.col("category").asc_nulls_last(),
    ).limit(n)
