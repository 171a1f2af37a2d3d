"""Silver order fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_by_key
from strata.schemas import AMOUNT


def order_amount(quantity: str = "quantity", unit_price: str = "unit_price"):
    """``round(quantity * unit_price, 2)`` as decimal(18,2); null when it does
    not fit (NaN, infinities and overflow), as with the legacy cast."""
    return F.round(F.col(quantity) * F.col(unit_price), 2).try_cast(AMOUNT)


def transform_fact_orders(orders_bronze: DataFrame, keys: str | Sequence[str] = "order_id") -> DataFrame:
    """One row per order, plus ``order_amount``.

    ``keys`` is the de-duplication key.  The default suits one business day's
    rows; pass ``("dt", "order_id")`` to build every day of a multi-day input
    at once, an order id counting once within each day.
    """
    return dedupe_by_key(orders_bronze, keys).withColumn("order_amount", order_amount())
