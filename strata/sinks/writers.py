"""Table writers.  Every write selects columns by the table's schema names
first, so a transform that appends a column at the end (as the fact build
does with ``order_amount``) still lands in DDL order."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.layout import OPEN_CLOSED_DT, SCD2_CLOSED_COL, TableSpec
from strata.sources.paths import landing_dir


def _refresh(df: DataFrame, path: str) -> None:
    """Drop this session's cached listing of a folder just rewritten, so the
    next read of the table sees the new files and not the replaced ones."""
    df.sparkSession.catalog.refreshByPath(path)


def _by_name(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])


def append_by_name(df: DataFrame, spec: TableSpec, root: str, rebalance: bool = False) -> None:
    """Append rows, binding columns by name (a rerun appends the day again,
    as the reference's bronze does; downstream de-duplicates).

    ``rebalance=True`` is for frames spanning many days (a backfill): rows are
    clustered by the partition columns first (AQE ``REBALANCE``, skewed days
    split), so each day gets a few full-size files.  A single day needs no
    extra shuffle: every input split writes one file."""
    rows = _by_name(df, spec)
    if rebalance:
        rows = rows.hint("rebalance", *spec.partition_by)
    rows.write.mode("append").partitionBy(*spec.partition_by).parquet(spec.path(root))
    _refresh(df, spec.path(root))


def replace_day(df: DataFrame, spec: TableSpec, root: str, dt: str) -> None:
    """Idempotent load of one business day: the ``dt=<dt>`` folder is
    replaced by ``df``; an empty ``df`` leaves the day empty.  Other days are
    untouched, and a row of another day (or none) fails the write: it would
    be lost.  A static overwrite of the one folder is used on purpose: a
    dynamic-partition overwrite of an empty frame would keep the old rows."""
    day = _dt.date.fromisoformat(str(dt)).isoformat()
    found = F.coalesce(F.col("dt").cast("string"), F.lit("no date"))
    foreign = F.raise_error(F.concat(F.lit(f"{spec.qualified_name}: a row of "), found, F.lit(f" in the load of {day}")))
    own = F.col("dt").eqNullSafe(F.to_date(F.lit(day)))
    rows = _by_name(df, spec).where(F.when(own, F.lit(True)).otherwise(foreign.cast("boolean"))).drop("dt")
    rows.write.mode("overwrite").parquet(f"{spec.path(root)}/dt={day}")
    _refresh(df, spec.path(root))


def write_dimension(
    spark: SparkSession,
    spec: TableSpec,
    root: str,
    current_and_closed: DataFrame,
    previously_closed_today: DataFrame | None,
    dt: str,
) -> None:
    """Rewrite the current folder and today's closed folder in one job.

    ``current_and_closed`` is ``unchanged ∪ expired ∪ inserted`` from
    :func:`strata.operators.scd2_plan`; rows already closed under ``dt`` (a
    rerun of the day) are carried over.  Dynamic partition overwrite replaces
    exactly the folders that receive rows; tasks write to a staging folder and
    the job commit moves them, so a lost executor only re-runs its tasks.
    """
    rows = _dimension_rows(spec, current_and_closed, previously_closed_today, dt)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*spec.partition_by)
        .parquet(spec.path(root))
    )
    _refresh(rows, spec.path(root))


def _dimension_rows(
    spec: TableSpec, current_and_closed: DataFrame, previously_closed_today: DataFrame | None, dt: str
) -> DataFrame:
    day = _dt.date.fromisoformat(str(dt)).isoformat()
    closed_dt = F.when(F.col("is_current"), F.to_date(F.lit(OPEN_CLOSED_DT))).otherwise(F.to_date(F.lit(day)))
    rows = _by_name(current_and_closed, spec).withColumn(SCD2_CLOSED_COL, closed_dt)
    if previously_closed_today is not None:
        rows = rows.unionByName(
            _by_name(previously_closed_today, spec).withColumn(SCD2_CLOSED_COL, F.to_date(F.lit(day)))
        )
    return rows


def write_dimension_table(
    spark: SparkSession,
    spec: TableSpec,
    table: str,
    current_and_closed: DataFrame,
    previously_closed_today: DataFrame | None,
    dt: str,
) -> None:
    """As :func:`write_dimension`, through a registered (bucketed) catalog
    table: ``insertInto`` keeps the table's bucketing.  The table's own options
    ask for the dynamic overwrite, so no session setting is touched and merges
    into several tables can run in one session."""
    rows = _dimension_rows(spec, current_and_closed, previously_closed_today, dt)
    cols = spark.table(table).columns  # the catalog orders partition columns last
    rows.select(*cols).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def export_landing(df: DataFrame, root: str, entity: str, dt: str | None = None) -> None:
    """Landing snapshot as headed CSV part files under
    ``<root>/raw/<entity>/dt=<dt>/``.

    With ``dt=None`` the frame's own ``dt`` column lays out one folder per
    day.  Rows are first rebalanced on ``dt`` (AQE ``REBALANCE``): files come
    out at the advisory partition size and a day holding a large share of
    all rows is split over several tasks, instead of every task writing a
    small file into every day it touches."""
    path = landing_dir(root, entity, dt)
    if dt is None:
        df.hint("rebalance", "dt").write.mode("overwrite").option("header", True).partitionBy("dt").csv(path)
    else:
        df.write.mode("overwrite").option("header", True).csv(path)
    _refresh(df, path)
