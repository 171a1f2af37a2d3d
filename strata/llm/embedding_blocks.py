"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors of each length are joined with each other, so the length is part of
every key below; its rotation, blocks and budgets are its own.

For unit vectors, cosine >= t is a squared distance <= 2 - 2t.  The vectors are
rotated (a fixed random orthogonal matrix spreads their energy) and split into
``blocks`` of few dimensions.  A linked pair must lie, in at least one block,
within that block's share of the squared distance.  Each block is range-joined
on its leading coordinate: slabs as wide as the block's radius, so a pair meets
in one slab or in two that touch.  Pairs within a block's budget are candidates
of the first such block only, which makes the union of the blocks free of
repeats, and each candidate is verified by its cosine in double precision.

A slab can hold any share of the vectors, so it is dealt into chunks of bounded
size, and a task compares one chunk with another (or with itself).  A task
returns, for each vector, how many links it found and the smallest vector it is
connected with there: rows in proportion to the vectors, never the pairs.

At this similarity a block's radius is close to the spread of unstructured
vectors, so for these the slabs prune little and the number of chunk pairs
grows with the square of a slab; vectors with structure prune more.

The nodes are rows, numbered when the vectors are stored; ids only name the
result.

Cases: vectors that are null, zero, or hold null or non-finite components link
with nothing and have their own row; so do those of another length than
``dims`` where that is given; a length below ``blocks`` has a block for each
dimension; rows that repeat a vec_id or have none are vectors of their own, and
a link between two of them counts; a component is named by its smallest
vec_id that isn't null (null, if it has none); ties need no rule; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, stored

THRESHOLD = 0.9
BLOCKS = 4
CHUNK = 8192
_SLACK = 1e-5


@functools.lru_cache(maxsize=8)
def rotation(dims: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _edges(dims: int, blocks: int) -> list[tuple[int, int]]:
    blocks = min(blocks, dims)
    at = [round(i * dims / blocks) for i in range(blocks + 1)]
    return list(zip(at, at[1:]))


def budgets(dims: int, blocks: int, threshold: float) -> list[float]:
    """Each block's share of the squared distance, by its dimensions."""
    return [(2 - 2 * threshold) * (b - a) / dims for a, b in _edges(dims, blocks)]


def unit(values: np.ndarray) -> np.ndarray:
    v = values.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def usable_rows(embedding: pa.Array, dims: int | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and float64 values of the vectors that can link, by length
    (of length ``dims`` only, if given)."""
    found: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    for i, v in enumerate(embedding.to_pylist()):
        if v and len(v) == (dims or len(v)) and None not in v:
            a = np.array(v, dtype=np.float64)
            if np.isfinite(a).all() and a.any():
                rows, values = found.setdefault(len(v), ([], []))
                rows.append(i)
                values.append(a)
    return {n: (np.array(rows, dtype=np.int64), np.array(values)) for n, (rows, values) in found.items()}


def vector_slabs(vectors: DataFrame, dims: int | None, threshold: float, blocks: int) -> DataFrame:
    """``(vec_id, deal, dims, vector, slabs)``: every vector with its row number
    ``deal``; ``vector`` and ``slabs``, its slab in each block, are null where it
    can't link."""
    schema = pa.schema([("vec_id", pa.int64()), ("deal", pa.int64()), ("dims", pa.int32()), ("vector", pa.binary()), ("slabs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = np.ones(batch.num_rows, dtype=bool)
            for n, (rows, values) in usable_rows(batch.column("embedding"), dims).items():
                rest[rows] = False
                lead = [a for a, _ in _edges(n, blocks)]
                width = np.sqrt(np.array(budgets(n, blocks, threshold)) + _SLACK)
                places = np.floor((unit(values) @ rotation(n))[:, lead] / width).astype(int)
                take = lambda c: batch.column(c).take(pa.array(rows))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [take("vec_id"), take("deal"), pa.array([n] * len(rows), pa.int32()), pa.array([v.tobytes() for v in values], pa.binary()), pa.array(places.tolist(), pa.list_(pa.int32()))],
                    schema=schema,
                )
            others = [batch.column(c).filter(pa.array(rest)) for c in ("vec_id", "deal")]
            yield pa.RecordBatch.from_arrays([*others, *(pa.nulls(len(others[0]), schema.field(c).type) for c in ("dims", "vector", "slabs"))], schema=schema)

    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.monotonically_increasing_id().alias("deal"))
    return source.mapInArrow(run, "vec_id long, deal long, dims int, vector binary, slabs array<int>")


def _tiles(placed: DataFrame, chunk: int) -> DataFrame:
    """Every vector once for each tile it takes part in.  ``first`` marks the
    side of the tile; a chunk meets itself, the later chunks of its slab, and
    all chunks of the next slab."""
    each = placed.select("dims", "vector", "deal", F.posexplode("slabs").alias("block", "slab"))
    # slabs of all blocks: bounded by blocks * 2 / radius for each length, whatever the number of vectors
    counts = {(r["dims"], r["block"], r["slab"]): math.ceil(r["count"] / chunk) for r in each.groupBy("dims", "block", "slab").count().collect()}
    plan = [(d, b, s, n, counts.get((d, b, s - 1), 0), counts.get((d, b, s + 1), 0)) for (d, b, s), n in counts.items()]
    spark = placed.sparkSession
    sizes = spark.createDataFrame(plan, "dims int, block int, slab int, chunks int, chunks_before int, chunks_after int")
    own = F.pmod(F.xxhash64("deal", "block"), F.col("chunks")).cast("int")
    dealt = each.join(F.broadcast(sizes), ["dims", "block", "slab"]).withColumn("own", own)
    tile = lambda s, a, s2, b, first: F.struct(s.alias("slab"), a.alias("a"), s2.alias("slab2"), b.alias("b"), F.lit(first).alias("first"))
    mine, slab = F.col("own"), F.col("slab")
    many = lambda n, f: F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), f)
    within = F.transform(F.sequence(mine, F.col("chunks") - 1), lambda j: tile(slab, mine, slab, j, True))
    later = many(mine, lambda i: tile(slab, i, slab, mine, False))
    ahead = many(F.col("chunks_after"), lambda j: tile(slab, mine, slab + 1, j, True))
    behind = many(F.col("chunks_before"), lambda j: tile(slab - 1, j, slab, mine, False))
    return dealt.select("dims", "vector", "deal", "block", F.explode(F.concat(within, later, ahead, behind)).alias("t")).select(
        "dims", "vector", "deal", "block", "t.*"
    )


def linked_pairs(left: np.ndarray, right: np.ndarray | None, block: int, blocks: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs (positions in left, in right) whose first block within
    budget is ``block``; with right None, each pair within left once."""
    dims = left.shape[1]
    turn, edges, share = rotation(dims), _edges(dims, blocks), budgets(dims, blocks, threshold)
    lu = unit(left)
    ru = lu if right is None else unit(right)
    lr = lu @ turn
    rr = lr if right is None else ru @ turn
    a, b = edges[block]
    x, y = lr[:, a:b].astype(np.float32), rr[:, a:b].astype(np.float32)
    # |x - y|^2 <= budget  <=>  x.y - |y|^2 / 2 >= (|x|^2 - budget) / 2
    y1 = np.hstack([y, -0.5 * np.einsum("ij,ij->i", y, y)[:, None]]).T
    need = 0.5 * (np.einsum("ij,ij->i", x, x) - share[block] - _SLACK)
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    for at in range(0, len(x), 256):
        near = x1[at : at + 256] @ y1 >= need[at : at + 256, None]
        if right is None:
            near &= np.arange(at, at + len(near))[:, None] < np.arange(len(y))[None, :]
        for part in np.array_split(np.flatnonzero(near), max(1, math.ceil(near.sum() / 50_000))):
            i, j = part // len(y) + at, part % len(y)
            gap = (lr[i] - rr[j]) ** 2
            ok = np.ones(len(i), dtype=bool)
            for n, (p, q) in enumerate(edges[: block + 1]):
                inside = gap[:, p:q].sum(axis=1) <= share[n] + _SLACK
                ok &= inside if n == block else ~inside
            ok &= np.einsum("ij,ij->i", lu[i], ru[j]) >= threshold
            if ok.any():
                yield i[ok], j[ok]


def _join(low: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels (positions) after linking the pairs; the smaller label wins."""
    a, b = low[i], low[j]
    apart = a != b
    if not apart.any():
        return low
    parent = np.arange(len(low))
    for x, y in np.unique(np.stack([a[apart], b[apart]], axis=1), axis=0).tolist():
        while parent[x] != x:
            x = parent[x]
        while parent[y] != y:
            y = parent[y]
        parent[max(x, y)] = min(x, y)
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return parent[low]


def compare_tiles(tiles: DataFrame, dims: int | None, blocks: int, threshold: float) -> DataFrame:
    """``(deal, links, root)``: for each vector of a tile that has links there;
    tiles of vectors of length ``dims`` only, if given."""

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n, block, slab, a, slab2, b = map(int, key)
        same = (slab, a) == (slab2, b)
        rows = rows.sort_values("deal", kind="stable")
        first = rows["first"].to_numpy(bool)
        ids = rows["deal"].to_numpy(np.int64)
        values = np.frombuffer(b"".join(rows["vector"]), dtype=np.float64).reshape(-1, n)
        li, ri = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(first), np.flatnonzero(~first))
        links = np.zeros(len(ids), dtype=np.int64)
        low = np.arange(len(ids))
        if len(li) and len(ri):
            for i, j in linked_pairs(values[li], None if same else values[ri], block, blocks, threshold):
                i, j = li[i], ri[j]
                np.add.at(links, i, 1)
                np.add.at(links, j, 1)
                low = _join(low, i, j)
        some = links > 0
        return pd.DataFrame({"deal": ids[some], "links": links[some], "root": ids[low][some]})

    chosen = tiles if dims is None else tiles.where(F.col("dims") == dims)
    return chosen.groupBy("dims", "block", "slab", "a", "slab2", "b").applyInPandas(compare, "deal long, links long, root long")


def near_duplicates(vectors: DataFrame, dims: int | None = None, threshold: float = THRESHOLD, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """``(vec_id, n_links, component_id)`` for every row of ``vectors`` with columns vec_id, embedding;
    vectors of every length are compared, or of length ``dims`` only."""
    placed = stored(vector_slabs(vectors, dims, threshold, blocks), "embedding-slabs")
    found = stored(compare_tiles(_tiles(placed, chunk), dims, blocks, threshold), "embedding-links")
    links = found.groupBy("deal").agg(F.sum("links").alias("n"))
    roots = connected_components(found.select(F.col("deal").alias("u"), F.col("root").alias("v")), "embedding")
    linked = links.join(roots, links["deal"] == roots["node"]).select(links["deal"].alias("at"), "n", "component")
    own = placed.select("vec_id", "deal")
    met = own.join(linked, own["deal"] == linked["at"], "left").select("vec_id", "n", "component")
    met = stored(met, "embedding-members")
    names = stored(met.where(F.col("component").isNotNull()).groupBy(F.col("component").alias("named")).agg(F.min("vec_id").alias("least")), "embedding-names")
    alone = met.where(F.col("component").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    grouped = met.join(names, met["component"] == names["named"]).select("vec_id", F.col("n").cast("long").alias("n_links"), F.col("least").alias("component_id"))
    return grouped.unionByName(alone)
