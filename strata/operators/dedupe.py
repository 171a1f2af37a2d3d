"""Latest row per key and deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators._common import orderable_columns


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest_per_key(
    df: DataFrame,
    key_col: str | Sequence[str],
    order_cols: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per key: the greatest by ``order_cols`` (each descending,
    nulls last).

    Ties are broken by ``tie_break`` (default: every other orderable column,
    also descending), so the winner is a function of the data alone and every
    re-evaluation of the plan (task retry, second action) picks the same row.

    ``row_number() = 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot key is cut to one row per map task before it
    moves; the shuffle carries at most (#map tasks) rows for any single key.
    """
    keys = _as_list(key_col)
    order = list(order_cols)
    if tie_break is None:
        tie_break = orderable_columns(df, set(keys) | set(order))
    recency = [F.col(c).desc_nulls_last() for c in dict.fromkeys([*order, *tie_break])]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*recency))
    return df.select("*", place.alias("__place")).where("__place = 1").select(*df.columns)


def dedupe_by_key(df: DataFrame, key_col: str | Sequence[str]) -> DataFrame:
    """``dropDuplicates(keys)`` with a deterministic choice: the most recently
    ingested row, then the greatest by the remaining columns."""
    keys = _as_list(key_col)
    order = ["ingest_ts"] if "ingest_ts" in df.columns and "ingest_ts" not in keys else []
    return latest_per_key(df, keys, order)
