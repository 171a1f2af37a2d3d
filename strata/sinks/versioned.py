"""Dimensions whose merges rewrite only the parts they touch.

A versioned dimension is a catalog table partitioned by ``(is_current,
closed_dt, key_part)``, ``key_part`` being a hash of the key.  A merge finds
the parts that hold a changed or new key, writes their rows to a folder of its
own, ``<location>/versions/v<n>``, and then points those partitions at it with
``ALTER TABLE ... SET LOCATION``.  Files that the catalog names are never
overwritten or removed, so until the first switch every reader sees the old
rows, and a run that ends before it leaves nothing but an unused folder.

The switches of one merge go in a fixed order, closed versions first.  Where a
run breaks off between the first and the last, its folder is complete, so the
next merge (or :func:`recover`) goes on where it stopped: one look at the
first and the last partition of the newest folder tells.  Until then, versions
that were closed in parts not yet switched are seen both closed and current.

Readers go through the catalog: ``spark.table(name)``, or
:func:`read_dimension` for the logical columns.  Folders that no partition
names any more stay until their owner removes them (:func:`unused_versions`).
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strata.operators._common import RunTs
from strata.operators.scd2 import ACTION, scd2_plan
from strata.plans.catalog import ensure_table, table_details
from strata.schemas import DIM_CUSTOMER
from strata.sinks.layout import SCD2_CLOSED_COL, TableSpec, dimension_spec
from strata.sinks.writers import _dimension_rows
from strata.sources.tables import folder_exists, list_folders

PART_COL = "key_part"
PARTS_PROPERTY = "strata.key_parts"
_VERSION = "v{:09d}"


def part_of(key_col: str, parts: int) -> Column:
    return F.pmod(F.hash(key_col), F.lit(parts))


def _spec(name: str, schema: StructType, key_col: str, location: str | None) -> TableSpec:
    base = dimension_spec(name, schema, key_col, location)
    extra = StructField(PART_COL, IntegerType(), True)
    return TableSpec(base.layer, base.name, base.schema, (*base.partition_by, PART_COL), (*base.storage_only, extra), key_col, location)


def create_versioned_dimension(spark: SparkSession, name: str, schema: StructType, key_col: str, root: str, parts: int = 64) -> TableSpec:
    """Create and register a versioned dimension under any ``layer.name``;
    ``schema`` holds the key and the tracked columns.  ``parts`` is fixed with
    the table: choose it so that a part's current rows make a file or two."""
    tail = [f for f in DIM_CUSTOMER.fields if f.name not in ("customer_id", "full_name", "email", "city")]
    spec = _spec(name, StructType([*schema.fields, *tail]), key_col, None)
    ensure_table(spark, spec, root)
    held = _parts(spark, name)
    if held not in (None, parts):
        raise ValueError(f"{name} has {held} key parts, not {parts}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PARTS_PROPERTY}' = '{parts}')")
    return spec


def _parts(spark: SparkSession, name: str) -> int | None:
    """The number of key parts; None for a table without them."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == PARTS_PROPERTY).collect()
    return int(rows[0]["value"]) if rows else None


def is_versioned(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and _parts(spark, name) is not None


def read_dimension(spark: SparkSession, name: str) -> DataFrame:
    """The whole dimension in its logical schema."""
    table = spark.table(name)
    return table.select(*[c for c in table.columns if c not in (SCD2_CLOSED_COL, PART_COL)])


def versions(spark: SparkSession, location: str) -> list[str]:
    """The folders of all merges so far, oldest first."""
    base = f"{location}/versions"
    return [f"{base}/{n}" for n in sorted(list_folders(spark, base)) if re.fullmatch(r"v\d+", n)]


def _partitions(spark: SparkSession, folder: str) -> list[str]:
    """``is_current=../closed_dt=../key_part=..`` of a merge's folder, in the
    order of the switches: closed versions come before current rows."""
    if not folder_exists(spark, f"{folder}/_SUCCESS"):
        return []  # its write was not finished
    found = [""]
    for _ in range(3):
        found = [f"{p}/{n}" if p else n for p in found for n in list_folders(spark, f"{folder}/{p}" if p else folder) if "=" in n]
    return sorted(found)


def _literal(partition: str) -> str:
    values = dict(p.split("=") for p in partition.split("/"))
    return f"(is_current={values['is_current']}, {SCD2_CLOSED_COL}=DATE'{values[SCD2_CLOSED_COL]}', {PART_COL}={values[PART_COL]})"


def _points_at(spark: SparkSession, name: str, partition: str, folder: str) -> bool:
    """Whether the catalog has the partition in a folder of a merge."""
    if not spark.sql(f"SHOW PARTITIONS {name} PARTITION {_literal(partition)}").collect():
        return False
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION {_literal(partition)}").where(F.col("col_name") == "Location").collect()
    return any(r["data_type"].rstrip("/").endswith(f"{folder.rsplit('/', 1)[1]}/{partition}") for r in rows)


def switch(spark: SparkSession, name: str, folder: str, partitions: Iterable[str]) -> None:
    """Point the partitions at a merge's folder, in their order; again does no
    harm.  New partitions that follow each other are one statement."""
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for old, run in groupby(partitions, key=known.__contains__):
        if old:
            for p in run:
                spark.sql(f"ALTER TABLE {name} PARTITION {_literal(p)} SET LOCATION '{folder}/{p}'")
        else:
            added = " ".join(f"PARTITION {_literal(p)} LOCATION '{folder}/{p}'" for p in run)
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(name)


def recover(spark: SparkSession, name: str) -> bool:
    """Finish the switches of a merge that broke off among them; True if there
    were any.  A merge that broke off before its first switch never happened."""
    folders = versions(spark, table_details(spark, name)["Location"])
    partitions = _partitions(spark, folders[-1]) if folders else []
    if not partitions or _points_at(spark, name, partitions[-1], folders[-1]) or not _points_at(spark, name, partitions[0], folders[-1]):
        return False
    switch(spark, name, folders[-1], partitions)
    return True


def unused_versions(spark: SparkSession, name: str) -> list[str]:
    """Folders of merges none of whose partitions the catalog names any more.
    A merge that is running has its folder among them."""
    location = table_details(spark, name)["Location"]
    return [f for f in versions(spark, location) if not any(_points_at(spark, name, p, f) for p in _partitions(spark, f))]


def merge_versioned(
    spark: SparkSession, stg: DataFrame, name: str, key_col: str, tracked_cols: Sequence[str], order_cols: Sequence[str], dt: str, run_ts: RunTs = None
) -> list[int]:
    """Merge one staged snapshot; returns the key parts that were rewritten.

    Two passes: the first compares keys and hashes only (of the stored rows it
    reads two columns) to find the parts with a new or changed key, the second
    reads and rewrites just those.  Their numbers, at most ``parts``, are all
    that reaches the driver."""
    recover(spark, name)
    parts, location = _parts(spark, name), table_details(spark, name)["Location"]
    day = _dt.date.fromisoformat(str(dt)).isoformat()
    run_ts = _dt.datetime.now(_dt.timezone.utc) if run_ts is None else run_ts
    table = spark.table(name)
    schema = StructType([f for f in table.schema.fields if f.name not in (SCD2_CLOSED_COL, PART_COL)])
    spec = _spec(name, schema, key_col, location)
    current = table.where(F.col("is_current"))
    part = part_of(key_col, parts)

    plan = scd2_plan(current.select(*schema.names), stg, key_col, tracked_cols, order_cols, run_ts).merged
    touched = sorted(r[0] for r in plan.where(F.col(ACTION) != "unchanged").select(part.alias("p")).distinct().collect())
    if not touched:
        return []
    own = F.col(PART_COL).isin(touched)
    rows = scd2_plan(
        current.where(own).select(*schema.names), stg.where(part.isin(touched)), key_col, tracked_cols, order_cols, run_ts
    ).current_and_closed()
    closed_today = table.where(~F.col("is_current") & (F.col(SCD2_CLOSED_COL) == F.to_date(F.lit(day))) & own).select(*schema.names)
    out = _dimension_rows(spec, rows, closed_today, day).withColumn(PART_COL, part)

    done = versions(spark, location)
    last = int(done[-1].rsplit("/v", 1)[1]) if done else 0
    folder = f"{location}/versions/{_VERSION.format(last + 1)}"
    out.hint("rebalance", *spec.partition_by).write.partitionBy(*spec.partition_by).parquet(folder)
    switch(spark, name, folder, _partitions(spark, folder))
    return touched
