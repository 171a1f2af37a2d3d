"""SimHash near-duplicates through an inverted index on fingerprint bytes.

A fingerprint is 64 bits, 8 positional bytes.  Two fingerprints within ``k``
differing bits differ in at most ``k`` bytes, so they share at least
``8 - k`` positional bytes (the guaranteed minimum).  The index splits the 8
positions into ``k + 2`` runs; a linked pair agrees on at least two whole
runs, so its postings are keyed by two runs (at ``k = 2``: 4 of the 8 bytes)
rather than by one byte: a one-byte posting would hold 1/256 of all
fingerprints and grow with the square of the input.  For every pair that
meets in a posting the shared positional bytes are tallied, pairs below the
guaranteed minimum are dropped, and the rest are verified by bit distance.

Postings hold distinct fingerprints only.  A posting of more than
``posting_limit`` members (a large family of near copies) is not expanded into
pairs: its members meet exactly instead through the fingerprints within
``k // 2`` bits of them, a fixed number of rows per member, and link to the
smallest member they meet there, which keeps every component whole.

Cases: null text counts as empty; a text without words has fingerprint zero
and links like any other; rows that repeat a document share its fingerprint;
a null doc_id is never a component's name unless the component has no other;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import connected_components, map_rows, stored

HASH_SEED = 42
POSTING_LIMIT = 32


def shingle_hashes(text: str | None, size: int) -> list[int]:
    """XXH64 of each word shingle; the whole sequence where it is shorter."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z, and ASCII white space
    if not words:
        return []
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[size - 1 :])]


def fingerprint(text: str | None, size: int = 3) -> int:
    """The signed 64-bit SimHash: a bit is set where over half the hashes set it."""
    hashes = np.array(shingle_hashes(text, size), dtype=">u8")
    if not len(hashes):
        return 0
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])

    def kernel(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text_key, text in rows:
            yield doc_id, text_key, fingerprint(text, size)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return source.mapInArrow(map_rows(kernel, ["doc_id", "text_key", "text"], schema), "doc_id long, text_key long, fp long")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the 8 positional bytes two fingerprints share."""
    return sum(F.when(_byte(a, p) == _byte(b, p), 1).otherwise(0) for p in range(8))


def _runs(max_bits: int) -> list[list[int]]:
    return [list(map(int, r)) for r in np.array_split(np.arange(8), max_bits + 2)]


def _postings(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(run_pair, positional_bytes, fp)``: one row for each pair of runs."""
    fp = F.col("fp")
    keys = []
    for n, (a, b) in enumerate(itertools.combinations(_runs(max_bits), 2)):
        mask = sum(255 << (8 * p) for p in (*a, *b))
        mask -= (1 << 64) * (mask >> 63)
        keys.append(F.struct(F.lit(n).alias("run_pair"), fp.bitwiseAND(F.lit(mask)).alias("positional_bytes")))
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.run_pair", "k.positional_bytes", "fp")


def _ball(radius: int) -> list[int]:
    masks = [sum(1 << i for i in bits) for r in range(radius + 1) for bits in itertools.combinations(range(64), r)]
    return [m - (1 << 64) * (m >> 63) for m in masks]


def _linked(pairs: DataFrame, max_bits: int) -> DataFrame:
    """Pairs that reach the guaranteed minimum of shared bytes, verified."""
    u, v = F.col("u"), F.col("v")
    return pairs.where(shared_bytes(u, v) >= 8 - max_bits).where(F.bit_count(u.bitwiseXOR(v)) <= max_bits)


def fingerprint_links(fps: DataFrame, max_bits: int = 2, posting_limit: int = POSTING_LIMIT) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints of column ``fp``, each
    within ``max_bits``, that connect all fingerprints so linked.  Postings up
    to the limit give all their pairs; larger ones give stars."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be between 0 and 3")
    key = ["run_pair", "positional_bytes"]
    postings = _postings(fps, max_bits)
    sizes = postings.groupBy(*key).agg(F.count("*").alias("size")).where("size > 1")
    sized = stored(postings.join(sizes, key).select("size", *key, "fp"), "simhash-postings")
    members = sized.where(F.col("size") <= posting_limit).groupBy(*key).agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    nested = F.expr("flatten(transform(fps, (x, i) -> transform(slice(fps, i + 2, size(fps)), y -> struct(x AS u, y AS v))))")
    pairs = _linked(members.select(F.explode(nested).alias("p")).select("p.u", "p.v"), max_bits)

    crowded = sized.where(F.col("size") > posting_limit).select("fp").distinct()
    near, far = _ball(max_bits // 2), _ball(max_bits - max_bits // 2)
    meet = lambda masks: crowded.select(
        "fp", F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("fp").bitwiseXOR(m))).alias("middle")
    )
    lowest = meet(near).groupBy("middle").agg(F.min("fp").alias("v"))
    star = _linked(meet(far).join(lowest, "middle").where("fp != v").select(F.col("fp").alias("u"), "v").distinct(), max_bits)
    return pairs.unionByName(star).distinct()


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, posting_limit: int = POSTING_LIMIT) -> DataFrame:
    """``(doc_id, text_key, fp, component_id)`` for every row of ``docs``:
    documents whose fingerprints are linked, directly or through others, have
    the smallest doc_id among them as ``component_id``."""
    prints = stored(fingerprints(docs, size), "simhash-prints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    edges = fingerprint_links(distinct.select("fp"), max_bits, posting_limit)
    roots = connected_components(edges, "simhash").select(F.col("node").alias("fp"), "component")
    named = distinct.join(roots, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    lookup = stored(named.join(names, "component").select("fp", "component", "component_id"), "simhash-components")
    return prints.join(lookup, "fp").select("doc_id", "text_key", "fp", "component", "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents, one row of each component: the smallest doc_id's (ties:
    the smallest text hash, then the smallest of the other columns)."""
    marked = near_duplicates(docs, size, max_bits)
    first = marked.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")).alias("k"))
    keep = stored(first.select(F.col("k.doc_id").alias("__id"), F.col("k.text_key").alias("__key")).distinct(), "simhash-keep")
    # plain equality on the same three columns serves the join and the window: one shuffle of the texts
    parts = [F.coalesce("__id", F.lit(0)).alias("__id"), F.col("__id").isNull().alias("__no_id"), "__key"]
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "__no_id": F.col("doc_id").isNull(), "__key": F.xxhash64("text")})
    kept = keyed.join(keep.select(*parts), ["__id", "__no_id", "__key"], "left_semi")
    order = [F.col(f.name) for f in docs.schema.fields if f.name not in ("doc_id", "text") and f.dataType.typeName() != "map"]
    once = Window.partitionBy("__id", "__no_id", "__key").orderBy(*(order or [F.lit(0)]))
    return kept.withColumn("__n", F.row_number().over(once)).where("__n = 1").select(*docs.columns)
