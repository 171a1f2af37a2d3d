"""Scans of stored (path-based, Hive-partitioned Parquet) tables.

A schema is always supplied, so no footer sampling happens and column order
is the logical one (Spark would otherwise move partition columns last).  A
scan of one partition names its folder, so only that folder is listed,
however many the table has; a folder that isn't there is an empty partition.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from strata.sinks.layout import SCD2_CLOSED_COL, TableSpec


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of its own file system.  Any error but
    its absence is raised."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf).exists(where)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none where it isn't there."""
    if not folder_exists(spark, path):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(where)
    return [f.getPath().getName() for f in found if f.isDirectory()]


def read_table(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """The whole table in its logical schema (storage-only columns dropped)."""
    df = spark.read.schema(spec.storage_schema).parquet(spec.path(root))
    return df.select(*spec.schema.names)


def read_folder(spark: SparkSession, spec: TableSpec, root: str, *partition: str) -> DataFrame:
    """One partition, given as ``name=value`` folders, in the logical schema."""
    base = spec.path(root)
    folder = "/".join([base, *partition])
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], spec.schema)
    df = spark.read.schema(spec.storage_schema).option("basePath", base).parquet(folder)
    return df.select(*spec.schema.names)


def read_day(spark: SparkSession, spec: TableSpec, root: str, dt: str) -> DataFrame:
    """One business day."""
    return read_folder(spark, spec, root, f"dt={_dt.date.fromisoformat(str(dt)).isoformat()}")


def read_current(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """The current rows of a dimension."""
    return read_folder(spark, spec, root, "is_current=true")


def read_closed(spark: SparkSession, spec: TableSpec, root: str, dt: str) -> DataFrame:
    """The dimension's versions closed by the run of one business day."""
    day = _dt.date.fromisoformat(str(dt)).isoformat()
    return read_folder(spark, spec, root, "is_current=false", f"{SCD2_CLOSED_COL}={day}")


__all__ = ["folder_exists", "list_folders", "read_closed", "read_current", "read_day", "read_folder", "read_table"]
