"""Slowly changing dimension, type 2, as a pure plan.

For a source key *k* and the target rows of *k* that are current:

* none                -> insert a new version
* same hash           -> untouched (keeps its old ``ingest_ts``)
* different hash      -> expire it (``is_current=false``, ``effective_to_ts``
  = run instant); insert a new version
* null stored hash    -> untouched, and it blocks the insert
* key absent in source -> untouched (deletes are not propagated)
* several current rows -> each differing one expires; insert only if none
  survives

After expiry every surviving current row has an equal or null hash, so the
insert set is ``source LEFT ANTI survivors ON key``.  A null source key never
matches anything and is always inserted.

One pass: the current rows and the staged rows are tagged, unioned and
gathered by key once; two windows over the key tell each row the staged hash
and whether a current row survives, one filter drops the staged rows that add
nothing.  Two shuffles (latest staged row per key, then the union), one scan
of each input, no join.  A null key matches nothing: a null source key is
always inserted, and rows without a key stay out of the key's group, each in
one of its own, so they never gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strata.functions import change_hash
from strata.operators._common import RunTs, run_ts_col
from strata.operators.dedupe import latest_per_key

HASH_COL = "hash_diff"
ACTION = "_action"


def add_hash_diff(df: DataFrame, tracked_cols: Sequence[str], hash_col: str = HASH_COL) -> DataFrame:
    return df.withColumn(hash_col, change_hash(tracked_cols))


class Scd2Result(NamedTuple):
    """One merge: its rows carry ``ACTION`` (unchanged, expired or inserted)."""

    merged: DataFrame

    def _part(self, action: str) -> DataFrame:
        return self.merged.where(F.col(ACTION) == action).drop(ACTION)

    @property
    def unchanged(self) -> DataFrame:
        return self._part("unchanged")

    @property
    def expired(self) -> DataFrame:
        return self._part("expired")

    @property
    def inserted(self) -> DataFrame:
        return self._part("inserted")

    def current_and_closed(self) -> DataFrame:
        return self.merged.drop(ACTION)


def dim_columns(key_col: str, tracked_cols: Sequence[str]) -> list[str]:
    return [key_col, *tracked_cols, HASH_COL, "effective_from_ts", "effective_to_ts", "is_current", "ingest_ts"]


def stage_source(
    stg: DataFrame, key_col: str, tracked_cols: Sequence[str], order_cols: Sequence[str]
) -> DataFrame:
    """Latest staged row per key with its change hash.  Ties after
    ``order_cols`` fall to the tracked columns, then the rest."""
    tie = [*tracked_cols, *[c for c in stg.columns if c not in (key_col, *order_cols, *tracked_cols)]]
    latest = latest_per_key(stg, key_col, order_cols, tie_break=tie)
    return add_hash_diff(latest, tracked_cols).select(key_col, *tracked_cols, HASH_COL, "ingest_ts")


def scd2_plan(
    current: DataFrame | None,
    stg: DataFrame,
    key_col: str,
    tracked_cols: Sequence[str],
    order_cols: Sequence[str],
    run_ts: RunTs = None,
) -> Scd2Result:
    """Merge one staged snapshot into the target's rows.

    ``current=None`` is a target without rows (first load): every staged key is
    inserted.  Rows of ``current`` that are not current pass through unchanged.
    """
    cols = dim_columns(key_col, tracked_cols)
    now = run_ts_col(run_ts)
    src = stage_source(stg, key_col, tracked_cols, order_cols)
    new = src.select(
        key_col,
        *tracked_cols,
        HASH_COL,
        now.alias("effective_from_ts"),
        F.lit(None).cast(TimestampType()).alias("effective_to_ts"),
        F.lit(True).alias("is_current"),
        "ingest_ts",
    )
    if current is None:
        return Scd2Result(new.withColumn(ACTION, F.lit("inserted")))

    rows = current.select(*cols, F.lit(False).alias("_staged")).unionByName(new.withColumn("_staged", F.lit(True)))
    alone = F.when(F.col(key_col).isNull(), F.monotonically_increasing_id())
    key = Window.partitionBy(key_col, "_alone")
    live = ~F.col("_staged") & F.coalesce("is_current", F.lit(False))
    differs = F.coalesce(F.col(HASH_COL) != F.col("_staged_hash"), F.lit(False))
    flagged = (
        rows.withColumn("_alone", alone)
        .withColumn("_staged_hash", F.max(F.when(F.col("_staged"), F.col(HASH_COL))).over(key))
        .withColumn("_expire", live & differs)
        .withColumn("_survives", F.max(live & ~differs).over(key))
        .where(~F.col("_staged") | ~F.col("_survives"))
    )
    action = F.when(F.col("_staged"), "inserted").when(F.col("_expire"), "expired").otherwise("unchanged")
    closed = {"is_current": F.lit(False), "effective_to_ts": now}
    return Scd2Result(
        flagged.select(
            *[F.when(F.col("_expire"), closed[c]).otherwise(F.col(c)).alias(c) if c in closed else F.col(c) for c in cols],
            action.alias(ACTION),
        )
    )


def scd2_plan_sql(
    current: DataFrame,
    stg: DataFrame,
    key_col: str,
    tracked_cols: Sequence[str],
    order_cols: Sequence[str],
    run_ts: RunTs = None,
) -> Scd2Result:
    """:func:`scd2_plan` as SQL text over the two frames.

    ``{current}`` and ``{stg}`` are bound to the frames themselves, not to view
    names of the session, so any number of merges can be planned side by side."""
    src = stage_source(stg, key_col, tracked_cols, order_cols).withColumn("_now", run_ts_col(run_ts))
    q = lambda names: ", ".join(f"`{n}`" for n in names)
    kept = q([key_col, *tracked_cols, HASH_COL])
    merged = stg.sparkSession.sql(
        f"""
        WITH rows AS (
          SELECT {kept}, effective_from_ts, effective_to_ts, is_current, ingest_ts, FALSE AS _staged, CAST(NULL AS TIMESTAMP) AS _now FROM {{current}}
          UNION ALL
          SELECT {kept}, _now, CAST(NULL AS TIMESTAMP), TRUE, ingest_ts, TRUE, _now FROM {{stg}}
        ), alone AS (
          SELECT *, CASE WHEN `{key_col}` IS NULL THEN monotonically_increasing_id() END AS _alone FROM rows
        ), met AS (
          SELECT *, max(CASE WHEN _staged THEN `{HASH_COL}` END) OVER k AS _staged_hash, max(_now) OVER k AS _end
          FROM alone WINDOW k AS (PARTITION BY `{key_col}`, _alone)
        ), flagged AS (
          SELECT *, NOT _staged AND coalesce(is_current, FALSE) AS _live, coalesce(`{HASH_COL}` <> _staged_hash, FALSE) AS _differs FROM met
        ), decided AS (
          SELECT *, _live AND _differs AS _expire, max(_live AND NOT _differs) OVER (PARTITION BY `{key_col}`, _alone) AS _survives FROM flagged
        )
        SELECT {kept}, effective_from_ts, CASE WHEN _expire THEN _end ELSE effective_to_ts END AS effective_to_ts,
               CASE WHEN _expire THEN FALSE ELSE is_current END AS is_current, ingest_ts,
               CASE WHEN _staged THEN 'inserted' WHEN _expire THEN 'expired' ELSE 'unchanged' END AS {ACTION}
        FROM decided WHERE NOT _staged OR NOT _survives
        """,
        current=current.select(*dim_columns(key_col, tracked_cols)),
        stg=src,
    )
    return Scd2Result(merged)


def split_dimension(dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current rows, all other rows).  A null ``is_current`` is not current."""
    current = dim.where(F.col("is_current"))
    rest = dim.where(~F.coalesce(F.col("is_current"), F.lit(False)))
    return current, rest


def scd2_apply(
    dim: DataFrame | None,
    stg: DataFrame,
    key_col: str,
    tracked_cols: Sequence[str],
    order_cols: Sequence[str],
    run_ts: RunTs = None,
) -> DataFrame:
    """The whole dimension, history included, after merging one staged snapshot
    (``dim=None``: first load into an empty dimension).  Applied day after day
    the plan grows by one union a day; stored dimensions are merged without
    their history (see :func:`strata.plans.daily.scd2_merge`)."""
    return scd2_plan(dim, stg, key_col, tracked_cols, order_cols, run_ts).current_and_closed()
