"""Stupid-backoff language-model scores of every document under the corpus.

S(w | context) is the relative frequency of the longest seen n-gram, times 0.4
for each step back (Brants et al., 2007).  A document is scored under the
counts of all other documents: its own counts are taken off first, so a
document never vouches for itself.

The scores are computed relationally.  Documents are dealt into blocks of
bounded size, stored as word hashes and word numbers.  Each block asks once for
every distinct n-gram it holds (``requests``: n-gram hashes packed by hash
bucket, with the block's own counts); by bucket, the requests add up to the
n-gram count table of that hash range and are answered from it (``count
table`` joined to the requests); by block, the answers meet the block's
documents again, and the log scores are summed per document.  An n-gram that
every document holds is one entry a block, so no bucket is hot; only hashes and
counts are moved.

Scores are sums of log probabilities rounded to millionths, kept as integers,
so that their sum does not depend on any order.

Cases: null text has no words and score 0; null doc_id and repeated rows are
scored each (copies see each other); an unseen word counts as half an
occurrence; a corpus of one document has nothing to score with, so each of its
words counts as unseen; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import rows_of, stored

ORDER = 2
BACKOFF = 0.4
BLOCK_CHARS = 10_000_000
BUCKET_CHARS = 8_000_000
MICRO = 1_000_000

_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.binary()), ("has_id", pa.binary()), ("lengths", pa.list_(pa.int32())), ("words", pa.binary()), ("vocabulary", pa.binary())])
BLOCK = "block long, doc_ids binary, has_id binary, lengths array<int>, words binary, vocabulary binary"


def squeeze(numbers: np.ndarray) -> bytes:
    """Numbers as compressed bytes: first all lowest bytes, then the next, so
    that the mostly empty high bytes cost next to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes())


def unsqueeze(packed: bytes, dtype: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).reshape(-1)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unsqueeze_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(packed, np.uint64), dtype=np.uint64)


def encode_block(texts: list[str | None]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Words a document, each word's number, and the hash of each number's word."""
    numbers: dict[bytes, int] = {}
    lengths, words = [], []
    for text in texts:
        split = (text or "").encode().split()
        lengths.append(len(split))
        words.extend([numbers.setdefault(w, len(numbers)) for w in split])
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), dtype=np.uint64, count=len(numbers))
    return lengths, np.array(words, dtype=np.uint32), hashes


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_keys(words: np.ndarray, hashes: np.ndarray, doc_of: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1..order: a key for the n-gram that ends at each word, and
    whether it lies within one document."""
    base = hashes[words]
    key, inside = _mix(base + np.uint64(1)), np.ones(len(words), dtype=bool)
    out = [(key, inside)]
    for n in range(2, order + 1):
        longer = np.zeros_like(key)
        longer[1:] = _mix(key[:-1] * np.uint64(3) + base[1:] + np.uint64(n))
        within = np.zeros_like(inside)
        within[n - 1 :] = doc_of[n - 1 :] == doc_of[: len(doc_of) - n + 1]
        key, inside = longer, within
        out.append((key, inside))
    return out


class Block:
    """A stored block, with its distinct n-grams ordered by bucket, then key."""

    def __init__(self, lengths, words: bytes, vocabulary: bytes, order: int, buckets: int):
        self.lengths = np.array(lengths, dtype=np.int64)
        self.doc_of = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.grams = ngram_keys(unsqueeze(words, np.uint32), np.frombuffer(vocabulary, dtype=np.uint64), self.doc_of, order)
        every = np.concatenate([k[inside] for k, inside in self.grams])
        keys, self.inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        self.order = np.argsort(bucket, kind="stable")
        self.keys, self.counts = keys[self.order], counts[self.order].astype(np.uint32)
        self.buckets, at = np.unique(bucket[self.order], return_index=True)
        self.cuts = [*at.tolist(), len(keys)]

    def scores(self, totals: np.ndarray, corpus_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per document: the score, the words scored by the longest n-gram, and the unseen words."""
        by_key = np.empty(len(totals), dtype=np.int64)
        by_key[self.order] = totals
        docs = len(self.lengths)
        others = np.maximum(corpus_words - self.lengths, 1)[self.doc_of]
        seen, at = [], 0
        for _, inside in self.grams:  # counts in the other documents, at each word
            inverse = self.inverse[at : at + int(inside.sum())]
            at += len(inverse)
            _, back, own = np.unique(inverse * docs + self.doc_of[inside], return_inverse=True, return_counts=True)
            rest = np.zeros(len(inside), dtype=np.int64)
            rest[inside] = by_key[inverse] - own[back]
            seen.append(rest)
        probability = np.where(seen[0] > 0, seen[0], 0.5) / others
        step = np.full(len(probability), len(seen) - 1)
        for n in range(1, len(seen)):
            context = np.ones(len(probability), dtype=np.int64)
            context[1:] = seen[n - 1][:-1]
            use = seen[n] > 0
            probability[use] = seen[n][use] / context[use]
            step[use] = len(seen) - 1 - n
        micro = np.rint((np.log(probability) + step * math.log(BACKOFF)) * MICRO).astype(np.int64)
        total = lambda values: np.array([s.sum() for s in np.split(values, np.cumsum(self.lengths)[:-1])], dtype=np.int64)
        return total(micro), total((step == 0).astype(np.int64)), total((seen[0] <= 0).astype(np.int64))


def blocks_of(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents in blocks; a document longer than a block is one of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        ids, texts, chars = [], [], 0

        def flush() -> pa.RecordBatch:
            lengths, words, hashes = encode_block(texts)
            numbers = np.array([i or 0 for i in ids], dtype=np.int64)
            known = np.array([i is not None for i in ids])
            row = [[first + n], [numbers.tobytes()], [known.tobytes()], [lengths], [squeeze(words)], [hashes.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, _BLOCK.types)], schema=_BLOCK)

        for doc_id, text in rows_of(batches, "doc_id", "text"):
            if ids and chars + len(text or "") > block_chars:
                yield flush()
                n, ids, texts, chars = n + 1, [], [], 0
            ids.append(doc_id)
            texts.append(text)
            chars += len(text or "")
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCK)


def requests(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """``(block, bucket, keys, counts)``: each block's distinct n-grams and how often it holds them."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lengths, words, vocabulary in rows_of(batches, "block", "lengths", "words", "vocabulary"):
            b = Block(lengths, words, vocabulary, order, buckets)
            cut = list(zip(b.cuts, b.cuts[1:]))
            cols = [[block] * len(cut), b.buckets.tolist(), [squeeze_sorted(b.keys[i:j]) for i, j in cut], [squeeze(b.counts[i:j]) for i, j in cut]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return blocks.select("block", "lengths", "words", "vocabulary").mapInArrow(run, "block long, bucket long, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """``(block, bucket, totals)``: the corpus counts of each request, in its order."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [unsqueeze_sorted(k) for k in rows["keys"]]
        counts = np.concatenate([unsqueeze(c, np.uint32) for c in rows["counts"]]).astype(np.float64)
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(inverse, weights=counts).astype(np.int64)[inverse]  # exact below 2^53
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "totals": [squeeze(t) for t in np.split(totals, cuts)]})

    return asked.groupBy("bucket").applyInPandas(count, "block long, bucket long, totals binary")


def document_scores(docs: DataFrame, order: int = ORDER, block_chars: int = BLOCK_CHARS, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``(doc_id, n_words, score_micro, n_longest, n_unseen)`` for every row of ``docs``."""
    blocks = stored(blocks_of(docs, block_chars), "lm-blocks", compression="zstd")
    size = blocks.agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("words"), F.sum(F.length("words")).alias("bytes")
    ).first()
    corpus_words = size["words"] or 0
    buckets = max(1, math.ceil(corpus_words * 6 / bucket_chars))
    replies = answers(requests(blocks, order, buckets))

    def score(held: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in held.itertuples():
            b = Block(row.lengths, row.words, row.vocabulary, order, buckets)
            parts = told.sort_values("bucket")["totals"]
            totals = np.concatenate([np.zeros(0, np.int64), *(unsqueeze(t, np.int64) for t in parts)])
            micro, longest, unseen = b.scores(totals, corpus_words)
            ids = pd.arrays.IntegerArray(np.frombuffer(row.doc_ids, np.int64).copy(), ~np.frombuffer(row.has_id, bool))
            out.append(pd.DataFrame({"doc_id": ids, "n_words": b.lengths, "score_micro": micro, "n_longest": longest, "n_unseen": unseen}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="Int64") for c in ("doc_id", "n_words", "score_micro", "n_longest", "n_unseen")})

    schema = "doc_id long, n_words long, score_micro long, n_longest long, n_unseen long"
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(score, schema)
