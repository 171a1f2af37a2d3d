"""Small shared helpers for operators: run stamps and column utilities."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, TimestampType, VariantType

RunTs = Column | str | _dt.datetime | None
Day = Column | str | _dt.date | None


def run_ts_col(run_ts: RunTs = None) -> Column:
    """The processing instant of a run.

    ``None`` means ``current_timestamp()`` (fixed once per query by Spark).
    A string or naive ``datetime`` is read as a wall clock in the session
    zone; pass one fixed value per run so every row of the run agrees.
    """
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts.cast(TimestampType())
    if isinstance(run_ts, _dt.datetime):
        if run_ts.tzinfo is not None:
            return F.lit(run_ts).cast(TimestampType())
        run_ts = run_ts.isoformat(sep=" ")
    return F.lit(str(run_ts)).cast(TimestampType())


def day_col(dt: Day) -> Column:
    """A business date: literal (validated ``YYYY-MM-DD``), column, or the
    existing ``dt`` column (``None``, e.g. from ``dt=`` partition discovery)."""
    if dt is None:
        return F.col("dt").cast("date")
    if isinstance(dt, Column):
        return dt.cast("date")
    if isinstance(dt, _dt.datetime):
        dt = dt.date()
    text = dt.isoformat() if isinstance(dt, _dt.date) else _dt.date.fromisoformat(str(dt)).isoformat()
    return F.to_date(F.lit(text))


def valid_key(name: str) -> Column:
    """Key present and not blank (applied after trimming)."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def _orderable(dtype: DataType) -> bool:
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (MapType, VariantType))


def orderable_columns(df: DataFrame, exclude: set[str]) -> list[str]:
    """Columns usable as a sort tie-break (maps and variants have no order,
    wherever they are nested)."""
    return [f.name for f in df.schema.fields if f.name not in exclude and _orderable(f.dataType)]
