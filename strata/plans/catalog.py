"""Catalog registration: databases per layer and one table per spec.

Tables are external (``LOCATION`` = the path the writers use), so the files
stay the source of truth and a new session re-registers them idempotently.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.sinks.layout import DIM_CUSTOMER, OPEN_CLOSED_DT, SCD2_CLOSED_COL, TABLES, TableSpec, dimension_spec, in_namespace
from strata.sources.tables import folder_exists

LAYERS = ("bronze", "silver", "gold")


def table_ddl(spec: TableSpec, root: str, buckets: int | None = None) -> str:
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.storage_schema.fields)
    parts = ", ".join(f"`{c}`" for c in spec.partition_by)
    clustered = f"\nCLUSTERED BY (`{spec.bucket_col}`) INTO {buckets} BUCKETS" if buckets else ""
    options = "\nOPTIONS (partitionOverwriteMode 'dynamic')" if spec.is_scd2 else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {spec.qualified_name} (\n  {cols}\n)\n"
        f"USING parquet{options}\nPARTITIONED BY ({parts}){clustered}\nLOCATION {_text(spec.path(root))}"
    )


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _norm(path: str) -> str:
    path = re.sub(r"^file:/+", "/", path)
    return path.rstrip("/")


def table_details(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def ensure_table(spark: SparkSession, spec: TableSpec, root: str, buckets: int | None = None) -> str:
    """Register ``spec`` at ``root`` (idempotent) and check that an existing
    registration points at the same folder with the same bucketing, so a
    session never reads or writes another warehouse by name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {spec.layer}")
    spark.sql(table_ddl(spec, root, buckets if spec.bucket_col else None))
    info = table_details(spark, spec.qualified_name)
    if _norm(info.get("Location", "")) != _norm(spec.path(root)):
        raise ValueError(f"{spec.qualified_name} is registered at {info.get('Location')}, not {spec.path(root)}")
    have = int(info["Num Buckets"]) if info.get("Num Buckets", "").strip().lstrip("-").isdigit() else None
    want = buckets if spec.bucket_col else None
    if (have or None) != want:
        raise ValueError(f"{spec.qualified_name} has {have} buckets, expected {want}")
    return spec.qualified_name


def ensure_catalog(
    spark: SparkSession, root: str, dim_buckets: int | None = None, ns: str | None = None
) -> None:
    """``CREATE DATABASE/TABLE IF NOT EXISTS`` for all layers and tables;
    ``dim_buckets`` registers the SCD2 dimensions bucketed by their key, ``ns``
    puts everything under a private namespace.  A table already registered
    at another warehouse (or with other bucketing) raises instead of being
    used silently."""
    for spec in TABLES:
        ensure_table(spark, in_namespace(spec, ns), root, dim_buckets)


def drop_registrations(spark: SparkSession, ns: str | None = None) -> None:
    """Forget the catalog entries of all tables (they are external: the
    files stay), e.g. before registering another warehouse in this session;
    a private namespace also loses its databases."""
    for spec in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {in_namespace(spec, ns).qualified_name}")
    if ns:
        for layer in LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS {ns}_{layer}")


def add_partitions(spark: SparkSession, spec: TableSpec, root: str, dt: str) -> None:
    """Show SQL over the catalog table what the run of ``dt`` wrote: only the
    folders of that run are added, nothing is listed."""
    for partition in _written(spark, spec, root, dt) if spec.is_scd2 else [f"(dt=DATE'{dt}')"]:
        spark.sql(f"ALTER TABLE {spec.qualified_name} ADD IF NOT EXISTS PARTITION {partition}")
    spark.catalog.refreshTable(spec.qualified_name)


def _written(spark: SparkSession, spec: TableSpec, root: str, dt: str) -> list[str]:
    """The partitions that the run of ``dt`` wrote and left rows in."""
    if not spec.is_scd2:
        return [f"(dt=DATE'{dt}')"] if folder_exists(spark, f"{spec.path(root)}/dt={dt}") else []
    folders = [("true", OPEN_CLOSED_DT), ("false", dt)]
    return [f"(is_current={c}, {SCD2_CLOSED_COL}=DATE'{d}')" for c, d in folders
            if folder_exists(spark, f"{spec.path(root)}/is_current={c}/{SCD2_CLOSED_COL}={d}")]


def analyze_run(spark: SparkSession, specs: Sequence[TableSpec], root: str, dt: str) -> None:
    """Row counts and sizes of the partitions that the run of ``dt`` wrote, and
    of the dimensions as a whole.  Nothing else is read: sizes come from file
    listings, row counts from the run's own partitions."""
    for spec in specs:
        for partition in _written(spark, spec, root, dt):
            spark.sql(f"ANALYZE TABLE {spec.qualified_name} PARTITION {partition} COMPUTE STATISTICS")
        if spec.is_scd2:
            spark.sql(f"ANALYZE TABLE {spec.qualified_name} COMPUTE STATISTICS NOSCAN")


def analyze_columns(spark: SparkSession, name: str, columns: Sequence[str]) -> None:
    """Column statistics (distinct counts, nulls, ranges, widths) of a table for
    the cost-based optimizer; reads the columns of the whole table."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")


def create_dimension(spark: SparkSession, name: str, schema: StructType, key_col: str, root: str) -> TableSpec:
    """Create and register an SCD2 dimension under any ``layer.name``;
    ``schema`` holds the key and the tracked columns."""
    tail = [f for f in DIM_CUSTOMER.schema.fields if f.name not in ("customer_id", "full_name", "email", "city")]
    spec = dimension_spec(name, StructType([*schema.fields, *tail]), key_col)
    ensure_table(spark, spec, root)
    return spec


def registered_dimension(spark: SparkSession, name: str, key_col: str, tracked_cols: Sequence[str]) -> TableSpec:
    """The layout of a registered dimension, from its schema and location."""
    table, info = spark.table(name), table_details(spark, name)
    logical = [f for f in table.schema.fields if f.name != SCD2_CLOSED_COL]
    wanted = {key_col, *tracked_cols, *(f.name for f in DIM_CUSTOMER.schema.fields[4:])}
    if wanted - {f.name for f in logical} or SCD2_CLOSED_COL not in table.columns:
        raise ValueError(f"{name} is not an SCD2 dimension of {sorted(wanted)} partitioned by is_current, {SCD2_CLOSED_COL}")
    return dimension_spec(name, StructType(logical), key_col, info["Location"])


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")
