"""Registered queries over the driver's tables (one per operator family).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Timestamps are returned as TIMESTAMP_NTZ (wall clock), so results
do not depend on the session zone; the processing instants are the fixed
``RUN1``/``RUN2`` of the two-day scenario.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from strata.config import scratch_path
from strata.functions import previous_business_date
from strata.operators import (
    add_hash_diff,
    build_daily_product_sales,
    enrich_sales,
    latest_per_key,
    scd2_apply,
    scd2_history,
    scd2_plan,
    scd2_plan_sql,
    split_dimension,
    standardize_customers,
    standardize_orders,
    standardize_products,
    top_sales,
    transform_fact_orders,
)
from strata.plans import adapters as A
from strata.plans.catalog import create_dimension, drop_registrations
from strata.plans.daily import DIMENSIONS, ingest_entity, merge_dimension, preview_sales, read_gold, run_day, scd2_merge
from strata.plans.together import together
from strata.schemas import CUSTOMER_DIM_SPEC, PRODUCT_DIM_SPEC
from strata.sinks.layout import FACT_ORDERS, TABLES, in_namespace
from strata.sinks.versioned import create_versioned_dimension, read_dimension
from strata.sinks.writers import export_landing
from strata.sources.landing import read_landing_days
from strata.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def wall_clock(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP columns to TIMESTAMP_NTZ in the session zone."""
    return df.select(
        *[
            F.col(f.name).cast(TimestampNTZType()).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


RUNS = {A.DAY1: A.RUN1, A.DAY2: A.RUN2, A.DAY3: A.RUN3}
BUCKETS = 16  # of the bucketed dimensions; a property of the stored tables


def _dim_spec(entity: str):
    """(dimension spec, raw snapshot adapter, standardizer) of an entity."""
    if entity == "customers":
        return CUSTOMER_DIM_SPEC, A.raw_customers, standardize_customers
    return PRODUCT_DIM_SPEC, A.raw_products, standardize_products


def staged(spark: SparkSession, sf_dir: str, entity: str, day: str, **raw_options) -> DataFrame:
    _, raw, std = _dim_spec(entity)
    return std(raw(spark, sf_dir, day, **raw_options), day, RUNS[day])


def dimension_after(spark: SparkSession, sf_dir: str, entity: str, *days: str, **raw_options) -> DataFrame:
    """The whole dimension after merging the days' snapshots in turn."""
    spec, dim = _dim_spec(entity)[0], None
    for day in days:
        stg = staged(spark, sf_dir, entity, day, **raw_options)
        dim = scd2_apply(dim, stg, spec["key"], spec["tracked"], spec["order"], RUNS[day])
    return dim


def day2_merge(spark: SparkSession, sf_dir: str, entity: str):
    spec = _dim_spec(entity)[0]
    current, _ = split_dimension(dimension_after(spark, sf_dir, entity, A.DAY1))
    stg2 = staged(spark, sf_dir, entity, A.DAY2)
    return scd2_plan(current, stg2, spec["key"], spec["tracked"], spec["order"], A.RUN2)


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_orders(A.raw_orders(spark, sf_dir), None, A.RUN1)


def fact_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_fact_orders(bronze_orders(spark, sf_dir), ("dt", "order_id"))


def current_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, _ = split_dimension(dimension_after(spark, sf_dir, "products", A.DAY1, A.DAY2, withheld=True))
    return current


def q_standardize_customers(spark, sf_dir):
    return wall_clock(standardize_customers(A.raw_customers_dirty(spark, sf_dir), A.DAY1, A.RUN1))


def q_standardize_products(spark, sf_dir):
    return wall_clock(standardize_products(A.raw_products_dirty(spark, sf_dir), A.DAY1, A.RUN1))


def q_standardize_orders(spark, sf_dir):
    return wall_clock(standardize_orders(A.raw_orders(spark, sf_dir, dirty=True), None, A.RUN1))


def q_latest_per_key(spark, sf_dir):
    return latest_per_key(A.table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def q_hash_diff(spark, sf_dir):
    stg = staged(spark, sf_dir, "customers", A.DAY1).unionByName(staged(spark, sf_dir, "customers", A.DAY2))
    out = add_hash_diff(stg, CUSTOMER_DIM_SPEC["tracked"]).select("customer_id", "updated_at", "hash_diff")
    return wall_clock(out)


def q_fact_orders(spark, sf_dir):
    return wall_clock(fact_all_days(spark, sf_dir))


def q_fact_orders_by_order_id(spark, sf_dir):
    return wall_clock(transform_fact_orders(bronze_orders(spark, sf_dir)))


def q_scd2_customers(spark, sf_dir):
    return wall_clock(dimension_after(spark, sf_dir, "customers", A.DAY1, A.DAY2))


def q_scd2_products(spark, sf_dir):
    return wall_clock(dimension_after(spark, sf_dir, "products", A.DAY1, A.DAY2))


def q_scd2_customers_three_days(spark, sf_dir):
    return wall_clock(dimension_after(spark, sf_dir, "customers", A.DAY1, A.DAY2, A.DAY3))


def q_scd2_expired(spark, sf_dir):
    return wall_clock(day2_merge(spark, sf_dir, "customers").expired)


def q_scd2_inserted(spark, sf_dir):
    return wall_clock(day2_merge(spark, sf_dir, "customers").inserted)


def q_scd2_customers_backfill(spark, sf_dir):
    """The three days' snapshots merged in one pass, however many there are."""
    spec, whole = CUSTOMER_DIM_SPEC, None
    for day in (A.DAY1, A.DAY2, A.DAY3):
        stg = staged(spark, sf_dir, "customers", day).withColumn("run_ts", F.to_timestamp(F.lit(RUNS[day])))
        whole = stg if whole is None else whole.unionByName(stg)
    return wall_clock(scd2_history(None, whole, spec["key"], spec["tracked"], spec["order"]))


def q_scd2_customers_sql(spark, sf_dir):
    """The day-2 customer merge planned by SQL over the frames."""
    spec = _dim_spec("customers")[0]
    current = dimension_after(spark, sf_dir, "customers", A.DAY1)
    stg2 = staged(spark, sf_dir, "customers", A.DAY2)
    return wall_clock(scd2_plan_sql(current, stg2, spec["key"], spec["tracked"], spec["order"], A.RUN2).current_and_closed())


def q_sales_enriched(spark, sf_dir):
    return wall_clock(enrich_sales(fact_all_days(spark, sf_dir), current_products(spark, sf_dir)))


def daily_sales(spark, sf_dir):
    return build_daily_product_sales(fact_all_days(spark, sf_dir), current_products(spark, sf_dir), A.RUN2, unique_orders=True)


def q_daily_product_sales(spark, sf_dir):
    return wall_clock(daily_sales(spark, sf_dir))


def q_sales_preview(spark, sf_dir):
    return wall_clock(top_sales(daily_sales(spark, sf_dir), 50))


def q_previous_business_date(spark, sf_dir):
    ts = F.col("ts")
    spring, autumn = ts + F.expr("INTERVAL 80 DAYS"), ts + F.expr("INTERVAL 300 DAYS")
    cols = {
        "london_prev_dt": (ts, "Europe/London"),
        "new_york_prev_dt": (ts, "America/New_York"),
        "london_prev_dt_spring": (spring, "Europe/London"),
        "new_york_prev_dt_spring": (spring, "America/New_York"),
        "london_prev_dt_autumn": (autumn, "Europe/London"),
        "new_york_prev_dt_autumn": (autumn, "America/New_York"),
    }
    events = A.table(spark, sf_dir, "events")
    return events.select(
        "event_id", "ts", *[previous_business_date(c, tz, source_tz="UTC").alias(n) for n, (c, tz) in cols.items()]
    )


def q_landing_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "landing")
    export_landing(A.raw_orders(spark, sf_dir), root, "orders")
    return read_landing_days(spark, root, "orders")


def _two_day_run(
    spark: SparkSession, sf_dir: str, ns: str | None = None, dim_buckets: int | None = None, register: bool = False,
    statistics: bool = False,
) -> tuple[str, str, DataFrame]:
    """Land two days of snapshots and orders, run the daily job for each;
    returns (landing root, warehouse root, raw orders).

    A day's exports run side by side, and the second day lands while the first
    is run, so that a cluster's cores don't wait for the last tasks of a step."""
    landing = scratch_path(spark, "pipeline-landing")
    warehouse = scratch_path(spark, "pipeline-warehouse")
    orders = A.raw_orders(spark, sf_dir)
    split = F.col("dt") < F.to_date(F.lit(A.PIPELINE_SPLIT))

    def landed(day: str, cond: Column) -> list[Callable[[], None]]:
        return [
            partial(export_landing, orders.where(cond).drop("dt"), landing, "orders", day),
            partial(export_landing, A.raw_customers(spark, sf_dir, day), landing, "customers", day),
            partial(export_landing, A.raw_products(spark, sf_dir, day, withheld=True), landing, "products", day),
        ]

    def run(day: str, run_ts: str) -> Callable[[], None]:
        return partial(run_day, spark, warehouse, day, run_ts, landing_root=landing, register=register, dim_buckets=dim_buckets, ns=ns, statistics=statistics)

    together(spark, *landed(A.DAY1, split))
    together(spark, run(A.DAY1, A.RUN1), *landed(A.DAY2, ~split))
    run(A.DAY2, A.RUN2)()
    return landing, warehouse, orders


def q_pipeline_two_days(spark, sf_dir):
    """Two daily runs from landed CSV to gold; the gold table."""
    _, warehouse, _ = _two_day_run(spark, sf_dir)
    return wall_clock(read_gold(spark, warehouse))


def q_pipeline_two_days_bucketed(spark, sf_dir):
    """The two daily runs with both dimensions kept as catalog tables bucketed
    by key, under a private namespace whose
    catalog entries are dropped again (the files stay); same gold as the path
    layout."""
    ns = f"chk{uuid.uuid4().hex[:12]}"
    try:
        _, warehouse, _ = _two_day_run(spark, sf_dir, ns=ns, dim_buckets=BUCKETS)
    finally:
        drop_registrations(spark, ns)
    return wall_clock(read_gold(spark, warehouse, ns))


def q_pipeline_replay_empty_day(spark, sf_dir):
    """After two daily runs, the source withdraws day 1's orders (a landed
    file with only the header) and day 1 is rerun idempotently: day 1's fact
    and gold folders are replaced by empty ones, day 2 is untouched."""
    landing, warehouse, orders = _two_day_run(spark, sf_dir)
    export_landing(orders.where(F.lit(False)).drop("dt"), landing, "orders", A.DAY1)
    run_day(spark, warehouse, A.DAY1, A.RUN3, landing_root=landing, bronze_mode="replace_day", register=False)
    return wall_clock(read_gold(spark, warehouse))


def _stored_dimension(spark: SparkSession, sf_dir: str, entity: str, *days: str, run_ts: dict | None = None) -> DataFrame:
    """Land the days' snapshots, run their bronze and dimension jobs, and read
    the stored dimension back, history included."""
    landing, warehouse = scratch_path(spark, "dim-landing"), scratch_path(spark, "dim-warehouse")
    dim_spec, stg_spec, dim = DIMENSIONS[entity]
    for day in days:
        run = (run_ts or {}).get(day)
        export_landing(_dim_spec(entity)[1](spark, sf_dir, day), landing, entity, day)
        ingest_entity(spark, warehouse, landing, entity, day, run)
        merge_dimension(spark, warehouse, day, dim_spec, stg_spec, dim, run)
    return read_table(spark, dim_spec, warehouse)


def q_pipeline_dim_customer(spark, sf_dir):
    """The stored customer dimension after three daily loads."""
    return wall_clock(_stored_dimension(spark, sf_dir, "customers", A.DAY1, A.DAY2, A.DAY3, run_ts=RUNS))


def q_pipeline_dim_product(spark, sf_dir):
    """The stored product dimension after three daily loads."""
    return wall_clock(_stored_dimension(spark, sf_dir, "products", A.DAY1, A.DAY2, A.DAY3, run_ts=RUNS))


def q_pipeline_default_clock(spark, sf_dir):
    """Two daily customer loads at whatever time it is: per customer what must
    hold at any time (one open version; a closed version ends when its
    successor starts; one instant a run)."""
    dim = _stored_dimension(spark, sf_dir, "customers", A.DAY1, A.DAY2)
    by_start = Window.partitionBy("customer_id").orderBy("effective_from_ts")
    next_start = F.lead("effective_from_ts").over(by_start)
    meets = F.col("is_current") | F.col("effective_to_ts").eqNullSafe(next_start)
    versions = dim.select("customer_id", "is_current", meets.alias("meets"), (F.col("ingest_ts") <= F.current_timestamp()).alias("past"))
    return versions.groupBy("customer_id").agg(
        F.count("*").alias("versions"), F.count_if("is_current").alias("open_versions"), F.bool_and("meets").alias("gapless"), F.bool_and("past").alias("past")
    )


def q_pipeline_fact(spark, sf_dir):
    """The stored order fact after two daily runs."""
    _, warehouse, _ = _two_day_run(spark, sf_dir)
    return wall_clock(read_table(spark, FACT_ORDERS, warehouse))


def q_pipeline_preview(spark, sf_dir):
    """The latest mart rows after two daily runs, read from the newest days."""
    _, warehouse, _ = _two_day_run(spark, sf_dir)
    return wall_clock(preview_sales(spark, warehouse, 50))


def q_pipeline_enriched_catalog(spark, sf_dir):
    """Two registered runs with statistics; the stored fact joined with the
    current product dimension, both read through the catalog by SQL."""
    ns = f"chk{uuid.uuid4().hex[:12]}"
    out = scratch_path(spark, "enriched-view")
    try:
        _two_day_run(spark, sf_dir, ns=ns, register=True, statistics=True)
        sales = spark.sql(
            f"SELECT f.dt, f.order_id, f.product_id, f.order_amount, d.category FROM {ns}_silver.fact_orders f "
            f"LEFT JOIN {ns}_silver.dim_product_scd2 d ON f.product_id = d.product_id AND d.is_current"
        )
        sales.write.parquet(out)
    finally:
        drop_registrations(spark, ns)
    return spark.read.parquet(out)


def q_pipeline_catalog(spark, sf_dir):
    """Two daily runs registered in the catalog under a private namespace:
    what SQL over each of the seven tables sees of each day (for the
    dimensions, of each state), read before the entries are dropped again."""
    ns = f"chk{uuid.uuid4().hex[:12]}"
    keys = {"customers_stg": "customer_id", "products_stg": "product_id", "orders_stg": "order_id", "dim_customer_scd2": "customer_id",
            "dim_product_scd2": "product_id", "fact_orders": "order_id", "daily_product_sales": "product_id"}
    out = scratch_path(spark, "catalog-view")
    try:
        _two_day_run(spark, sf_dir, ns=ns, register=True)
        parts = []
        for spec in TABLES:
            day = "CASE WHEN is_current THEN 'open' ELSE 'closed' END" if spec.is_scd2 else "CAST(dt AS STRING)"
            name = in_namespace(spec, ns).qualified_name
            parts.append(
                f"SELECT '{spec.qualified_name}' AS table_name, {day} AS part, count(*) AS n_rows, count(DISTINCT {keys[spec.name]}) AS n_keys "
                f"FROM {name} GROUP BY 2"
            )
        spark.sql(" UNION ALL ".join(parts)).write.parquet(out)
    finally:
        drop_registrations(spark, ns)
    return spark.read.parquet(out)


def q_scd2_suppliers(spark, sf_dir):
    """A supplier dimension, no part of the warehouse's own tables: created in
    the catalog, merged by name over two days, read back."""
    ns = f"chk{uuid.uuid4().hex[:12]}"
    name, root = f"{ns}_silver.dim_supplier", scratch_path(spark, "suppliers")
    days = [A.staged_suppliers(spark, sf_dir, day, RUNS[day]) for day in (A.DAY1, A.DAY2)]
    try:
        spec = create_dimension(spark, name, days[0].select("supplier_id", "name", "nation").schema, "supplier_id", root)
        for stg, run in zip(days, (A.RUN1, A.RUN2)):
            scd2_merge(spark, stg, name, "supplier_id", ["name", "nation"], ["updated_at", "ingest_ts"], run_ts=run)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP DATABASE IF EXISTS {ns}_silver")
    return wall_clock(read_table(spark, spec, root))


def q_pipeline_dim_versioned(spark, sf_dir):
    """The customer dimension kept as a versioned table over three daily
    merges: each rewrites the key parts it touches and switches them in the
    catalog; read through the catalog before its entries are dropped again."""
    ns = f"chk{uuid.uuid4().hex[:12]}"
    name, out = f"{ns}_silver.dim_customer", scratch_path(spark, "versioned-view")
    spec = CUSTOMER_DIM_SPEC
    try:
        columns = staged(spark, sf_dir, "customers", A.DAY1).select(spec["key"], *spec["tracked"]).schema
        create_versioned_dimension(spark, name, columns, spec["key"], scratch_path(spark, "versioned"), BUCKETS)
        for day in (A.DAY1, A.DAY2, A.DAY3):
            stg = staged(spark, sf_dir, "customers", day)
            scd2_merge(spark, stg, name, spec["key"], spec["tracked"], spec["order"], dt=day, run_ts=RUNS[day])
        wall_clock(read_dimension(spark, name)).write.parquet(out)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP DATABASE IF EXISTS {ns}_silver")
    return spark.read.parquet(out)


QUERIES: dict[str, Query] = {
    "standardize_customers": q_standardize_customers,
    "standardize_products": q_standardize_products,
    "standardize_orders": q_standardize_orders,
    "latest_per_key": q_latest_per_key,
    "hash_diff": q_hash_diff,
    "fact_orders": q_fact_orders,
    "scd2_customers": q_scd2_customers,
    "scd2_products": q_scd2_products,
    "scd2_customers_three_days": q_scd2_customers_three_days,
    "scd2_expired": q_scd2_expired,
    "scd2_inserted": q_scd2_inserted,
    "sales_enriched": q_sales_enriched,
    "daily_product_sales": q_daily_product_sales,
    "sales_preview": q_sales_preview,
    "previous_business_date": q_previous_business_date,
    "landing_roundtrip": q_landing_roundtrip,
    "pipeline_two_days": q_pipeline_two_days,
    "pipeline_replay_empty_day": q_pipeline_replay_empty_day,
    "pipeline_two_days_bucketed": q_pipeline_two_days_bucketed,
    "fact_orders_by_order_id": q_fact_orders_by_order_id,
    "pipeline_dim_customer": q_pipeline_dim_customer,
    "pipeline_dim_product": q_pipeline_dim_product,
    "pipeline_default_clock": q_pipeline_default_clock,
    "pipeline_fact": q_pipeline_fact,
    "pipeline_catalog": q_pipeline_catalog,
    "scd2_suppliers": q_scd2_suppliers,
    "pipeline_dim_versioned": q_pipeline_dim_versioned,
    "pipeline_preview": q_pipeline_preview,
    "pipeline_enriched_catalog": q_pipeline_enriched_catalog,
    "scd2_customers_backfill": q_scd2_customers_backfill,
    "scd2_customers_sql": q_scd2_customers_sql,
}
