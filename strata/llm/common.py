"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.config import scratch_path

#: The white space of the word rule ``[^\x20\x09-\x0D]+``; also what ``bytes.split()`` splits on.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage with files that survive the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns of Arrow batches as Python rows."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def map_rows(kernel: Callable[[Iterator[tuple]], Iterator[tuple]], names: list[str], schema: pa.Schema, batch_rows: int = 4096):
    """A ``mapInArrow`` function from a kernel over row tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for row in kernel(rows_of(batches, *names)):
            out.append(row)
            if len(out) >= batch_rows:
                yield to_batch(out, schema)
                out = []
        if out:
            yield to_batch(out, schema)

    return run


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def unit_interval(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the key's text and the seed: the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns that are named alike on the left and, with ``__`` before, on the right."""
    together = F.lit(True)
    for n in names:
        together = together & left[n].eqNullSafe(right[f"__{n}"])
    return together


def dealt(rows: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``rows`` sorted by ranges of ``group`` and ``order`` and stored, with a
    unique ``row_id`` that ascends with the sort inside a task.

    A group that holds a third of the rows takes a third of the tasks.  Rows
    equal in ``order`` are parted by their place in the input, so that repeated
    rows don't meet in one task either."""
    keys = [*(F.col(g).asc_nulls_first() for g in group), *order, F.col("__nth").asc()]
    spread = rows.withColumn("__nth", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(spread.drop("__nth").withColumn("row_id", F.monotonically_increasing_id()), name, compression="zstd")


def positions(placed: DataFrame, group: list[str]) -> DataFrame:
    """``placed`` (of ``dealt``) with ``position`` (from 0) in their group and
    ``total``, the group's rows; nulls are a group of their own.  Only counts
    by task and group are summed up."""
    task = F.shiftright("row_id", 33)  # where the id of a row has its task
    runs = placed.groupBy(task.alias("__task"), *group).agg(F.min("row_id").alias("__from"), F.count("*").alias("__n"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__from")
    runs = runs.select("__task", *(F.col(g).alias(f"__{g}") for g in group), offset.alias("__offset"), F.sum("__n").over(whole).alias("total"))
    joined = placed.join(runs, (task == runs["__task"]) & same(placed, runs, *group))
    return joined.select(*placed.columns, (F.col("row_id") + F.col("__offset")).alias("position"), "total")


HUB_PARTS = 64


def _with_least(pairs: DataFrame) -> DataFrame:
    """``(u, v, m)``: each pair with the least ``v`` of its ``u``.  Pairs meet it
    by node and part; a node's window holds a row a part, not a row a pair."""
    parted = pairs.withColumn("__part", F.pmod(F.xxhash64("v"), F.lit(HUB_PARTS)))
    parts = parted.groupBy("u", "__part").agg(F.min("v").alias("w"))
    least = parts.select("u", "__part", F.min("w").over(Window.partitionBy("u")).alias("m"))
    return parted.join(least, ["u", "__part"]).select("u", "v", "m")


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of an undirected graph given as ``(u, v)`` longs.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): each
    round links every node's neighbours to its smallest known neighbour, so
    the edge count never grows and a logarithmic number of rounds is typical.
    A round is joins and map-side combined minima; a node's edges are dealt to
    ``HUB_PARTS`` parts, so that a hub's don't meet in one task; each round's edges are written to shared storage and two scalars
    reach the driver.  Returns ``(node, component)`` for nodes with an edge,
    ``component`` being the smallest node reachable.
    """
    e = stored(
        edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        f"{name}-edges",
    )
    state = _fingerprint(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = F.least("u", "m")
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), lowest.alias("v")).distinct()
        links = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        e = stored(_with_least(large).select(F.inline(links)).where("u != v").distinct(), f"{name}-star")
        before, state = state, _fingerprint(e)
        if state == before:
            break
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _fingerprint(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
