import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import simhash_index as S


def plain(text, size=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits):
    """Smallest id (None last) of each id's component; prints: [(id, fingerprint)]."""
    values = sorted({p for _, p in prints})
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    array = np.array(values, dtype=np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= bits) + i + 1:
            parent[find(values[j])] = find(v)
    low = {}
    for doc_id, p in sorted(prints, key=lambda r: (r[0] is None, r[0] or 0)):
        low.setdefault(find(p), doc_id)
    return [(i, low[find(p)]) for i, p in prints]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["A", "b", "É", " ", "\n", "\x0b", "　", "longer", "Zz"]), max_size=25).map("".join))
def test_fingerprint(text):
    assert S.fingerprint(text) % 2**64 == plain(text)


def test_documents_against_brute_force(docs, rows):
    prints = [(r[0], plain(r[1])) for r in rows]
    got = S.near_duplicates(docs, posting_limit=4).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter(components(prints, 2))
    kept = S.drop_near_duplicates(docs)
    out = kept.collect()
    assert kept.columns == docs.columns
    named = dict(zip((p for _, p in prints), (c for _, c in components(prints, 2))))
    assert Counter(named[plain(r["text"])] for r in out) == Counter(set(named.values()))
    assert all(r["doc_id"] == named[plain(r["text"])] for r in out)


def family(rng, size, bits):
    centre = rng.getrandbits(64)
    return [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits))) for _ in range(size)]


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("limit", [2, 8, 10_000])
def test_links_connect_what_brute_force_connects(spark, bits, limit):
    """Dense families cross the posting limit; pairs and stars must agree."""
    rng = random.Random(bits * 31 + limit)
    values = {v for size, spread in ((60, 3), (40, 2), (25, 6), (5, 1)) for v in family(rng, size, spread)} | {rng.getrandbits(64) for _ in range(60)} | {0, 1, 2**63}
    signed = [v - (v >> 63 << 64) for v in values]
    edges = [(r["u"] % 2**64, r["v"] % 2**64) for r in S.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), bits, limit).collect()]
    assert all(u != v and (u ^ v).bit_count() <= bits for u, v in edges)
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for u, v in edges:
        parent[find(u)] = find(v)
    groups = {}
    for v in values:
        groups.setdefault(find(v), set()).add(v)
    want = {}
    for v, name in components([(v, v) for v in values], bits):
        want.setdefault(name, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_large_postings_give_no_pairs(spark):
    rng = random.Random(1)
    values = list(set(family(rng, 600, 3)))
    df = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "fp long")
    assert S.fingerprint_links(df, 2, 8).count() < 40 * len(values) < len(S.fingerprint_links(df, 2, 10_000).collect()) * 2 + 40 * len(values)


def test_shared_bytes(spark):
    df = spark.createDataFrame([(0, 0, 8), (0, -1, 0), (1, 257, 7), (-1, 2**62 - 1, 7)], "a long, b long, n int")
    assert all(r[0] == r[1] for r in df.select(S.shared_bytes(F.col("a"), F.col("b")), "n").collect())


def test_empty(no_docs):
    assert S.near_duplicates(no_docs).collect() == [] and S.drop_near_duplicates(no_docs).collect() == []
