"""The daily run: one business day through bronze, silver and gold.

Order (each step reads only what earlier steps wrote): catalog ->
bronze customers, products, orders -> customer dimension -> product
dimension -> order fact -> daily product sales.  Layers exchange data only
through stored tables, which also cuts lineage between steps.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import (
    build_daily_product_sales,
    scd2_plan,
    standardize_customers,
    standardize_orders,
    standardize_products,
    top_sales,
    transform_fact_orders,
)
from strata.operators._common import RunTs, run_ts_col
from strata.plans.catalog import add_partitions, analyze_run, ensure_catalog, ensure_table, registered_dimension
from strata.plans.together import together
from strata.schemas import CUSTOMER_DIM_SPEC, PRODUCT_DIM_SPEC
from strata.sinks import layout as L
from strata.sinks.versioned import is_versioned, merge_versioned
from strata.sinks.writers import append_by_name, replace_day, write_dimension, write_dimension_table
from strata.sources.landing import RAW_COLUMNS, read_landing
from strata.sources.paths import landing_dir
from strata.sources.tables import folder_exists, list_folders, read_closed, read_current, read_day, read_table

BRONZE: tuple[tuple[str, Callable, L.TableSpec], ...] = (
    ("customers", standardize_customers, L.CUSTOMERS_STG),
    ("products", standardize_products, L.PRODUCTS_STG),
    ("orders", standardize_orders, L.ORDERS_STG),
)


def ingest_entity(
    spark: SparkSession,
    root: str,
    landing_root: str,
    entity: str,
    dt: str,
    run_ts: RunTs,
    mode: str = "append",
    ns: str | None = None,
) -> None:
    """One bronze job: the landed file of ``entity`` for ``dt`` -> bronze."""
    _, standardize, spec = next(b for b in BRONZE if b[0] == entity)
    spec = L.in_namespace(spec, ns)
    raw = read_landing(spark, landing_dir(landing_root, entity, dt), RAW_COLUMNS[entity])
    out = standardize(raw, dt, run_ts)
    if mode == "replace_day":
        replace_day(out, spec, root, dt)
    else:
        append_by_name(out, spec, root)


def ingest_bronze(
    spark: SparkSession,
    root: str,
    landing_root: str,
    dt: str,
    run_ts: RunTs,
    mode: str = "append",
    ns: str | None = None,
    side_by_side: bool = True,
) -> None:
    steps = [partial(ingest_entity, spark, root, landing_root, entity, dt, run_ts, mode, ns) for entity, _, _ in BRONZE]
    _run(spark, steps, side_by_side)


def _run(spark: SparkSession, steps: Sequence[Callable[[], None]], side_by_side: bool) -> None:
    if side_by_side:
        together(spark, *steps)
    else:
        for step in steps:
            step()


def _target_rows(spark: SparkSession, spec: L.TableSpec, root: str, day: str) -> tuple[DataFrame | None, DataFrame | None]:
    """The current rows and the versions that an earlier run of ``day`` closed;
    None twice where the dimension has no rows yet.  History without a current
    folder is what a commit that broke off leaves: merging into it would lose
    every key that the staged rows don't have."""
    path = spec.path(root)
    if not folder_exists(spark, f"{path}/is_current=true"):
        if folder_exists(spark, f"{path}/is_current=false"):
            raise RuntimeError(f"{path} has history but no current rows: an earlier merge broke off; restore is_current=true first")
        return None, None
    return read_current(spark, spec, root), read_closed(spark, spec, root, day)


def _staged_day(stg: DataFrame, run_ts: RunTs) -> str:
    """The staged rows' single date, else the run's."""
    if "dt" in stg.columns:
        low, high = stg.agg(F.min("dt"), F.max("dt")).first()
        if low is not None and low == high:
            return str(low)
    return str(stg.sparkSession.range(1).select(run_ts_col(run_ts).cast("date")).first()[0])


def scd2_merge(
    spark: SparkSession,
    stg: DataFrame,
    target_table: str | L.TableSpec,
    key_col: str,
    tracked_cols: Sequence[str],
    order_cols: Sequence[str],
    root: str | None = None,
    dt: str | None = None,
    run_ts: RunTs = None,
    buckets: int | None = None,
) -> None:
    """Merge one staged snapshot into a stored SCD2 dimension.

    ``target_table`` is the name of any dimension registered in the catalog
    (see :func:`strata.plans.catalog.create_dimension`), or with ``root`` a
    :class:`TableSpec` or the name of one of the warehouse's own dimensions.
    ``dt`` is the business day of the run (it names the folder that receives
    the versions this run closes); the default is the staged rows' single
    date, else the date of the run.  Only the current folder and that day's
    closed folder are read and rewritten; older history is not touched.  Of a
    versioned dimension (:mod:`strata.sinks.versioned`) only the parts with a
    changed or new key are, and the catalog switches to them.

    ``buckets=N`` keeps the dimension as a catalog table bucketed by its key
    into N buckets.  A warehouse is either bucketed or not from its first run
    on.
    """
    registered = root is None
    if registered:
        if not isinstance(target_table, str):
            raise ValueError("a TableSpec needs the root of its warehouse")
        if is_versioned(spark, target_table):
            merge_versioned(spark, stg, target_table, key_col, tracked_cols, order_cols, dt or _staged_day(stg, run_ts), run_ts)
            return
        spec, root = registered_dimension(spark, target_table, key_col, tracked_cols), ""
    else:
        spec = L.table_spec(target_table) if isinstance(target_table, str) else target_table
    day = _dt.date.fromisoformat(str(dt)).isoformat() if dt else _staged_day(stg, run_ts)
    current, closed_today = _target_rows(spark, spec, root, day)
    if buckets:
        name = ensure_table(spark, spec, root, buckets)
        if current is not None:
            current = spark.table(name).where(F.col("is_current")).select(*spec.schema.names)
    rows = scd2_plan(current, stg, key_col, tracked_cols, order_cols, run_ts).current_and_closed()
    if buckets:
        write_dimension_table(spark, spec, name, rows, closed_today, day)
        return
    write_dimension(spark, spec, root, rows, closed_today, day)
    if registered:
        add_partitions(spark, spec, root, day)


def merge_dimension(
    spark: SparkSession,
    root: str,
    dt: str,
    spec: L.TableSpec,
    stg_spec: L.TableSpec,
    dim: dict,
    run_ts: RunTs,
    buckets: int | None = None,
) -> None:
    stg = read_day(spark, stg_spec, root, dt)
    scd2_merge(spark, stg, spec, dim["key"], dim["tracked"], dim["order"], root, dt, run_ts, buckets)


def load_fact(spark: SparkSession, root: str, dt: str, ns: str | None = None) -> None:
    fact = transform_fact_orders(read_day(spark, L.in_namespace(L.ORDERS_STG, ns), root, dt))
    replace_day(fact, L.in_namespace(L.FACT_ORDERS, ns), root, dt)


def load_gold(spark: SparkSession, root: str, dt: str, run_ts: RunTs, ns: str | None = None) -> None:
    fact = read_day(spark, L.in_namespace(L.FACT_ORDERS, ns), root, dt)
    dim = read_current(spark, L.in_namespace(L.DIM_PRODUCT, ns), root)  # by path: bucketing not needed here
    gold = build_daily_product_sales(fact, dim, run_ts, unique_orders=True)  # load_fact keeps an order id once
    replace_day(gold, L.in_namespace(L.DAILY_PRODUCT_SALES, ns), root, dt)


DIMENSIONS = {
    "customers": (L.DIM_CUSTOMER, L.CUSTOMERS_STG, CUSTOMER_DIM_SPEC),
    "products": (L.DIM_PRODUCT, L.PRODUCTS_STG, PRODUCT_DIM_SPEC),
}


def run_day(
    spark: SparkSession,
    root: str,
    dt: str,
    run_ts: RunTs = None,
    landing_root: str | None = None,
    bronze_mode: str = "append",
    register: bool = True,
    dim_buckets: int | None = None,
    ns: str | None = None,
    side_by_side: bool = True,
    statistics: bool = False,
) -> None:
    """Run all data steps for business day ``dt`` against warehouse ``root``.

    Steps that don't need each other run at the same time: the three bronze
    loads, then both dimensions beside the fact, then the mart.  A failing step
    fails the run once the others of its group have stopped; no later group
    begins.  ``side_by_side=False`` runs them one after another.
    ``statistics=True`` (with ``register``) gathers catalog statistics of what
    the run wrote (:func:`strata.plans.catalog.analyze_run`).

    ``run_ts`` is the run's processing instant (one value for the whole run,
    so an expired version's end meets its successor's start exactly).
    ``dim_buckets`` keeps both dimensions bucketed by key (see
    :func:`scd2_merge`); ``ns`` puts every table under a private namespace
    (databases ``<ns>_bronze`` ..., folders ``<root>/<ns>_bronze/...``).
    """
    dt = _dt.date.fromisoformat(str(dt)).isoformat()
    run_ts = _dt.datetime.now(_dt.timezone.utc) if run_ts is None else run_ts
    if register:
        ensure_catalog(spark, root, dim_buckets, ns)
    ingest_bronze(spark, root, landing_root or root, dt, run_ts, bronze_mode, ns, side_by_side)
    silver = [
        partial(merge_dimension, spark, root, dt, L.in_namespace(dim_spec, ns), L.in_namespace(stg_spec, ns), dim, run_ts, dim_buckets)
        for dim_spec, stg_spec, dim in DIMENSIONS.values()
    ]
    _run(spark, [*silver, partial(load_fact, spark, root, dt, ns)], side_by_side)
    load_gold(spark, root, dt, run_ts, ns)
    if register:  # SQL over the catalog sees the new folders right away
        specs = [L.in_namespace(spec, ns) for spec in L.TABLES]
        for spec in specs:
            add_partitions(spark, spec, root, dt)
        if statistics:
            analyze_run(spark, specs, root, dt)


def preview_sales(spark: SparkSession, root: str, n: int = 50, ns: str | None = None) -> DataFrame:
    """The first ``n`` mart rows, latest days first, reading only the newest
    days that hold them.

    The day is the partition, so the folders' names give the order.  Days are
    taken from the newest on, twice as many each time, until their row counts
    (which Parquet keeps in its footers) reach ``n``; only their folders are
    opened and sorted, whatever the mart's history.  Rows without a day come
    last, as in :func:`strata.operators.top_sales`."""
    spec = L.in_namespace(L.DAILY_PRODUCT_SALES, ns)
    path = spec.path(root)
    days = sorted((d for d in list_folders(spark, path) if d.startswith("dt=")), key=lambda d: ("__HIVE" not in d, d), reverse=True)
    reader = spark.read.schema(spec.storage_schema).option("basePath", path)
    if not days:
        return top_sales(spark.createDataFrame([], spec.schema), n)
    taken, rows = 0, 0
    while rows < n and taken < len(days):
        more = days[taken : 2 * taken + 1]
        rows += reader.parquet(*[f"{path}/{d}" for d in more]).count()
        taken += len(more)
    return top_sales(reader.parquet(*[f"{path}/{d}" for d in days[:taken]]).select(*spec.schema.names), n)


def read_gold(spark: SparkSession, root: str, ns: str | None = None) -> DataFrame:
    return read_table(spark, L.in_namespace(L.DAILY_PRODUCT_SALES, ns), root)
