"""Many daily snapshots merged into an SCD2 dimension in one pass.

The result is that of one :func:`strata.operators.scd2_apply` a day, in the
order of the days, without a plan that grows with them: a back-fill of a year
takes the two shuffles of a single merge.

Each day's staged rows are cut to the latest row per key, then gathered by key
with the target's current rows.  Along the days a key's hashes form islands; a
row starts a version where its hash differs from that of the key's day before.
What the target held decides the beginning: a current row with the key's first
hash stands for the first island, a current row with a null hash matches
nothing, stays, and blocks every insert.  A version ends at the next start, a
current row at the first day whose hash differs from its own.  A key that is
missing on a day is left as it is.  Rows without a key match nothing: each
day's is inserted and stays open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from strata.operators.dedupe import latest_per_key
from strata.operators.scd2 import HASH_COL, add_hash_diff, dim_columns


def scd2_history(
    dim: DataFrame | None,
    staged: DataFrame,
    key_col: str,
    tracked_cols: Sequence[str],
    order_cols: Sequence[str],
    day_col: str = "dt",
    run_col: str = "run_ts",
    keep_closed_day: bool = False,
) -> DataFrame:
    """The whole dimension after merging every day of ``staged``.

    ``staged`` has the day of each row and the processing instant of that day's
    run (one a day, ascending with the days).  ``dim=None``: an empty target.
    ``keep_closed_day`` adds ``closed_dt``, the day that closed a version here
    (null for open versions and for rows closed before)."""
    cols = dim_columns(key_col, tracked_cols)
    # the day is part of the key: the latest row of each key and day
    keyed = staged.withColumn("_key", F.struct(F.col(day_col).alias("d"), F.col(key_col).alias("k")))
    tie = [*tracked_cols, *[c for c in staged.columns if c not in (key_col, *order_cols, *tracked_cols)]]
    latest = add_hash_diff(latest_per_key(keyed, "_key", order_cols, tie_break=tie), tracked_cols)
    new = latest.select(
        key_col, *tracked_cols, HASH_COL, F.col(run_col).cast(TimestampType()).alias("effective_from_ts"),
        F.lit(None).cast(TimestampType()).alias("effective_to_ts"), F.lit(True).alias("is_current"), "ingest_ts",
        F.col(day_col).cast(DateType()).alias("_day"), F.lit(True).alias("_staged"),
    )
    rows = new
    if dim is not None:
        old = dim.select(*cols, F.lit(None).cast(DateType()).alias("_day"), F.lit(False).alias("_staged"))
        rows = old.unionByName(new)

    rows = rows.withColumn("_alone", F.when(F.col(key_col).isNull(), F.monotonically_increasing_id()))
    key = Window.partitionBy(key_col, "_alone")
    days = key.orderBy(F.col("_day").asc_nulls_first())
    before, whole = days.rowsBetween(Window.unboundedPreceding, -1), days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    when_staged = lambda c: F.when(F.col("_staged"), F.col(c))
    live = ~F.col("_staged") & F.coalesce("is_current", F.lit(False))
    rows = (
        rows.withColumn("_previous", F.last(when_staged(HASH_COL), ignorenulls=True).over(before))
        .withColumn("_first", F.first(when_staged(HASH_COL), ignorenulls=True).over(whole))
        .withColumn("_blocked", F.max(live & F.col(HASH_COL).isNull()).over(whole))
        .withColumn("_starts", F.col("_staged") & (F.col("_previous").isNull() | (F.col("_previous") != F.col(HASH_COL))))
        .withColumn("_stands", F.max(live & F.coalesce(F.col(HASH_COL) == F.col("_first"), F.lit(False))).over(whole))
        .where(~F.col("_staged") | F.col("_starts"))
    )
    # what is left are the target's rows and one staged row an island, in order
    start = F.struct(F.col("effective_from_ts").alias("ts"), F.col("_day").alias("day"))
    island = F.row_number().over(days) - F.sum(F.when(F.col("_staged"), 0).otherwise(1)).over(whole)
    rows = (
        rows.withColumn("_island", F.when(F.col("_staged"), island))
        .withColumn("_next", F.lead(start).over(days))
        .withColumn("_at1", F.first(F.when(F.col("_island") == 1, start), ignorenulls=True).over(whole))
        .withColumn("_at2", F.first(F.when(F.col("_island") == 2, start), ignorenulls=True).over(whole))
        .where(~F.col("_staged") | (~F.col("_blocked") & ~((F.col("_island") == 1) & F.col("_stands"))))
    )
    own_end = F.when(F.col(HASH_COL) != F.col("_first"), F.col("_at1")).when(F.col(HASH_COL) == F.col("_first"), F.col("_at2"))
    end = F.when(F.col("_staged"), F.col("_next")).when(live, own_end)
    ended = rows.withColumn("_end", end)
    ends = F.col("_end").isNotNull()
    closed = {"is_current": F.lit(False), "effective_to_ts": F.col("_end.ts")}
    out = ended.select(
        *[F.when(ends, closed[c]).otherwise(F.col(c)).alias(c) if c in closed else F.col(c) for c in cols],
        F.when(ends, F.col("_end.day")).alias("closed_dt"),
    )
    return out if keep_closed_day else out.drop("closed_dt")
