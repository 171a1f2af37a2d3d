import datetime as dt

from strata.compat import compute_yesterday_dt, scd2_merge, transform_customers
from strata.sinks import layout as L
from strata.sources import read_current, read_table

UTC = dt.timezone.utc


def test_compute_yesterday_dt_clock_cases():
    cases = {  # instant (UTC): the London day before
        (2025, 9, 1, 12, 30): "2025-08-31",
        (2025, 1, 1, 0, 1): "2024-12-31",
        (2024, 10, 27, 0, 30): "2024-10-26",  # the hour before the clocks go back
        (2025, 6, 9, 23, 5): "2025-06-09",  # already the 10th in London
    }
    for instant, day in cases.items():
        assert compute_yesterday_dt(dt.datetime(*instant, tzinfo=UTC)) == {"dt": day}


def test_scd2_merge_into_stored_dimension_by_name(spark, tmp_root):
    cols = ["customer_id", "full_name", "email", "city", "updated_at"]
    day1 = transform_customers(spark.createDataFrame([("C1", "Alice", "a@x", "London", "2026-02-20 10:00:00")], cols),
                               "2026-02-20", "2026-02-21 06:00:00")
    day2 = transform_customers(spark.createDataFrame([("C1", "Alice", "a@x", "Oxford", "2026-02-21 10:00:00")], cols),
                               "2026-02-21", "2026-02-22 06:00:00")
    args = ("customer_id", ["full_name", "email", "city"], ["updated_at", "ingest_ts"])
    scd2_merge(spark, day1, "silver.dim_customer_scd2", *args, root=tmp_root, dt="2026-02-20", run_ts="2026-02-21 06:00:00")
    scd2_merge(spark, day2, "silver.dim_customer_scd2", *args, root=tmp_root, dt="2026-02-21", run_ts="2026-02-22 06:00:00")
    scd2_merge(spark, day2, "silver.dim_customer_scd2", *args, root=tmp_root, dt="2026-02-21", run_ts="2026-02-22 07:00:00")
    rows = sorted((r["city"], r["is_current"]) for r in read_table(spark, L.DIM_CUSTOMER, tmp_root).collect())
    assert rows == [("London", False), ("Oxford", True)]
    assert [r["city"] for r in read_current(spark, L.DIM_CUSTOMER, tmp_root).collect()] == ["Oxford"]


def test_original_keyword_names_bind(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from strata.compat import (
        add_hash_diff,
        build_daily_product_sales,
        latest_per_key,
        raw_entity_path,
        transform_fact_orders,
        transform_orders,
    )

    stg = spark.createDataFrame([("C1", "a", "2026-02-20 10:00:00")], ["customer_id", "full_name", "updated_at"])
    assert latest_per_key(stg, key_col="customer_id", order_cols=["updated_at"]).count() == 1
    assert "h" in add_hash_diff(stg, tracked_cols=["full_name"], hash_col="h").columns
    bronze = spark.createDataFrame([("O1", 2, 3.5)], ["order_id", "quantity", "unit_price"])
    assert transform_fact_orders(orders_bronze=bronze).collect()[0]["order_amount"] == Decimal("7.00")
    fact = spark.createDataFrame(
        [("2026-02-20", "O1", "C1", "P1", 1, Decimal("1.00"))],
        ["dt", "order_id", "customer_id", "product_id", "quantity", "order_amount"],
    ).withColumn("dt", F.to_date("dt"))
    dim = spark.createDataFrame([("P1", "c")], ["product_id", "category"])
    assert build_daily_product_sales(fact_orders=fact, dim_product_current=dim).count() == 1
    raw = spark.createDataFrame([("O1", "2026-02-20 09:00:00", "C1", "P1", "1", "1.0")],
                                ["order_id", "order_ts", "customer_id", "product_id", "quantity", "unit_price"])
    assert transform_orders(raw, "2026-02-20").count() == 1
    assert raw_entity_path(bucket="b", entity="orders", dt="2026-02-20", filename="orders.csv") == (
        "s3://b/raw/orders/dt=2026-02-20/orders.csv"
    )
