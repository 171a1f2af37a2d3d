"""Mixing of sources to target weights by repetition.

Sizes are summed by source, each source gets a target share, and its rate is
the target over its size: a document is taken floor(rate) times, and once more
if a number fixed by its doc_id and the seed falls below the fraction.  The
decision needs nothing but the document and its source's rate, so a retried
task repeats it.

Targets share the total by weight; one that would exceed ``MOST`` times its
source's size stops there and the excess goes to the others by weight, until
none is above.  The sources that stop are found in rounds over the table of
sources (one row a source): only sums reach the driver.

Cases: null text has size 0; a null source is one source, ordered last; a source
of size 0 has target 0 and its documents are taken once each (they add no words);
repeated rows share their decision; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored, unit_interval

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_ranks(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``, its 0-based place by code point, null last:
    range-partitioned, ranked within each part, shifted by the parts before."""
    order = F.col("source").asc_nulls_last()
    parts = stored(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))  # one row a partition
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return parts.join(shifts, "part").withColumn("rank", F.col("shift") + place).drop("part", "shift")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, source_size)``."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = stored(source_ranks(sizes).withColumn("weight", weight.cast("long")).drop("rank"), "source-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    capped, left, shares = -1, total, 0
    stops = F.lit(False)
    while True:
        row = weighed.agg(
            F.count(F.when(stops, 1)), F.sum(F.when(stops, F.col("source_size"))), F.sum(F.when(~stops, F.col("weight")))
        ).first()
        if row[0] == capped:
            break
        capped, left, shares = row[0], total - most * (row[1] or 0), row[2] or 0
        # a target of left * weight / shares above most * size stops there
        stops = F.col("weight").cast("decimal(38,0)") * F.lit(left) > F.col("source_size").cast("decimal(38,0)") * F.lit(most * shares)
    share = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(max(shares, 1)))
    target = F.when(stops, (F.col("source_size") * most).cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(1.0)
    return weighed.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def copies(key: Column, rate: Column, seed: int = SEED) -> Column:
    """floor(rate), and one more with the probability of the fraction."""
    whole = F.floor(rate)
    return (whole + F.when(unit_interval(key, seed) < rate - whole, 1).otherwise(0)).cast("int")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``docs`` with ``__size``, ``__source_size``, ``__target`` and ``__copies``."""
    sized = docs.withColumn("__size", word_count(F.col("text")))
    totals = docs.select("source", word_count(F.col("text")).alias("n")).groupBy("source").agg(F.sum("n").alias("source_size"))
    goals = targets(totals, weights, most).select(
        F.col("source").alias("__s"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("rate").alias("__rate")
    )
    joined = sized.join(goals, sized["source"].eqNullSafe(goals["__s"]))
    return joined.withColumn("__copies", copies(F.col("doc_id"), F.col("__rate"), seed)).drop("__s", "__rate")


def emit(planned: DataFrame) -> DataFrame:
    """The rows of ``plan_mix`` as often as the mix takes them, numbered by
    ``__copy`` from 1; a row that it doesn't take comes once with a null."""
    again = F.when(F.col("__copies") > 0, F.sequence(F.lit(1), F.col("__copies")))
    return planned.select("*", F.explode_outer(again).alias("__copy"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every row as often as the mix takes it."""
    return emit(plan_mix(docs, weights, most, seed)).where("__copy IS NOT NULL").select(*docs.columns)
