"""Packing of tokenized documents into fixed-length sequences.

A document longer than a sequence is cut into full pieces and a rest.  The
pieces are dealt into random groups of bounded size; each group is packed on
its own by first-fit decreasing, where a tournament tree over the free space of
the open sequences finds the first one that fits in logarithmic time.  Only
the last sequences of a group stay partly empty, so the padding falls with the
group size and no task ever sees more than one group.

A piece's place in the deal is drawn once, with the piece, and stored: repeated
documents are spread over groups and a retried task sees the same groups.

Cases: null text counts as empty (a document of the end id alone); a null doc_id
is kept; repeated rows are packed each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.common import map_rows, stored
from strata.llm.tokenization import shared_encoder

SEQUENCE = 4096
GROUP_TOKENS = 2_000_000
_BINS = 1 << 32

PIECE = "doc_id long, start long, length long, doc_tokens long, place long, ids binary"


class Tournament:
    """Free space of the open bins; every inner node holds its larger child."""

    def __init__(self, capacity: int, most: int):
        self.size = 1 << max(0, (most - 1).bit_length())
        self.tree = [capacity] * (2 * self.size)

    def first_fit(self, need: int) -> tuple[int, int]:
        """Put ``need`` into the first bin with room; returns the bin and the
        space that was free there."""
        tree, node = self.tree, 1
        while node < self.size:
            node *= 2
            if tree[node] < need:
                node += 1
        free, found = tree[node], node - self.size
        tree[node] = free - need
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
        return found, free


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """``(bin, offset)`` of each item; items must not exceed the capacity."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    # twice the total is enough for first fit: no two bins are both half empty
    bins = Tournament(capacity, min(len(lengths), 2 * sum(lengths) // capacity + 2))
    for i in order:
        found, free = bins.first_fit(lengths[i])
        places[i] = found, capacity - free
    return places


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, sequence: int = SEQUENCE, seed: int = 11) -> DataFrame:
    """Each document's pieces of at most ``sequence`` ids, with their place in
    the deal; ids are in the encoder's narrow type."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("doc_tokens", pa.int64()), ("place", pa.int64()), ("ids", pa.binary()),
    ])

    def kernel(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = shared_encoder(tokenizer, False)
        width = encoder.dtype.itemsize
        end = end_id.to_bytes(width, "little")
        deal = random.Random(f"{seed}:{TaskContext.get().partitionId()}")
        for doc_id, ids in encoder.encode_rows(rows):
            ids += end
            total = len(ids) // width
            for start in range(0, total, sequence):
                part = ids[start * width : (start + sequence) * width]
                yield doc_id, start, len(part) // width, total, deal.getrandbits(62), part

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(map_rows(kernel, ["doc_id", "text"], schema, 1024), PIECE)


def widened(ids: Iterable[bytes], lengths: np.ndarray) -> list[bytes]:
    """The pieces' ids as little-endian uint32, all of a group at once."""
    narrow = b"".join(ids)
    wide = np.frombuffer(narrow, dtype=f"<u{len(narrow) // int(lengths.sum())}").astype("<u4").tobytes()
    ends = (4 * lengths.cumsum()).tolist()
    return [wide[a:b] for a, b in zip([0, *ends], ends)]


def pack(parts: DataFrame, sequence: int = SEQUENCE, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``parts`` (columns ``length`` and ``place``, and any others) with
    ``sequence_id`` and ``offset``; ``ids``, if there, are widened to uint32.
    ``parts`` must be stored, not recomputed."""
    total = parts.agg(F.sum("length")).first()[0] or 0
    groups = max(1, math.ceil(total / group_tokens))
    kept = [f for f in parts.schema.fields if f.name != "place"]
    schema = StructType([*kept, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def fill(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "place"], ascending=[False, True], kind="stable")
        placed = first_fit_decreasing(group["length"].tolist(), sequence)
        group["sequence_id"] = [key[0] * _BINS + b for b, _ in placed]
        group["offset"] = [at for _, at in placed]
        if "ids" in group:
            group["ids"] = widened(group["ids"], group["length"].to_numpy())
        return group.drop(columns=["place", "group"])

    return parts.withColumn("group", F.pmod("place", F.lit(groups))).groupBy("group").applyInPandas(fill, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, sequence: int = SEQUENCE, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row a piece, with its ids as little-endian uint32."""
    return pack(stored(pieces(docs, tokenizer, end_id, sequence), "pieces", compression="zstd"), sequence, group_tokens)


def sequences(packed: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``(sequence_id, length, padded_length, ids)`` from packed pieces with
    ids: at most ``sequence`` ids a row.  A length that is a power of two is
    left as it is, any other is padded to the full length by the reader."""
    joined = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]).alias("parts"),
    )
    ids = F.aggregate("parts", F.lit(b""), lambda a, b: F.concat(a, b))
    power = F.bit_count(F.col("length")) == 1
    return joined.select("sequence_id", "length", F.when(power, F.col("length")).otherwise(sequence).alias("padded_length"), ids.alias("ids"))
