"""The manifest against a tree built in plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.llm import merkle_manifest as M
from tests.llm.conftest import DOCUMENTS


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])]
    return H("".join(parts))


def climb(nodes):
    """The root, and the ``(left, right)`` segments of each node's proof."""
    proofs = [[] for _ in nodes]
    level, held = list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        upper, below = [], []
        for i in range(0, len(level), 3):
            run = level[i : i + 3]
            for k in range(len(run)):
                for n in held[i + k]:
                    proofs[n].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(H("".join(run)))
            below.append(sum(held[i : i + 3], []))
        level, held = upper, below
    return level[0], proofs


def manifest(rows):
    by_source: dict = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by_source[s])]) for s in order}
    root, upper = climb([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, upper):
        for (_, _, d, doc_id), proof in zip(sorted(by_source[s]), trees[s][1]):
            out.append((doc_id, s, d, tuple(proof + up), trees[s][0], root))
    return out


def collected(df):
    return [(r.doc_id, r.source, r.leaf, tuple((s.left, s.right) for s in r.proof), r.subroot, r.root) for r in df.collect()]


def key(r):
    return (r[1] or "", r[1] is None, r[0] is None, r[0] or 0, r[2], r[3])


def test_against_plain_trees(docs, rows):
    assert sorted(collected(M.build(docs).leaves), key=key) == sorted(manifest(rows), key=key)


def test_several_rounds_of_blocks_and_many_sources(spark):
    rng = random.Random(3)
    sizes = {None: 1, "": 2, "hot": 3 * M.BLOCK + 5, "exact": M.BLOCK, "over": M.BLOCK + 1, "Z": 4, "é": 9, "a": 10} | {f"s{i:03d}": 1 + i % 3 for i in range(300)}
    rows = [(rng.randrange(10**9), f"text {i}\n", "en", s, i) for s, n in sizes.items() for i in range(n)]
    rows += [rows[5], (None, None, None, "hot", None), (None, "", None, "hot", 0)]
    rng.shuffle(rows)
    made = M.build(spark.createDataFrame(rows, DOCUMENTS).repartition(7))
    assert sorted(collected(made.leaves), key=key) == sorted(manifest(rows), key=key)
    sources = made.sources.collect()
    assert {r.source: r.documents for r in sources} == {s: sum(x[3] == s for x in rows) for s in sizes}
    assert len({r.root for r in sources}) == 1


@pytest.mark.parametrize("block_levels", [1, 2])
def test_small_blocks_recurse_deeply(spark, monkeypatch, block_levels):
    monkeypatch.setattr(M, "LEVELS", block_levels)
    monkeypatch.setattr(M, "BLOCK", M.ARITY**block_levels)
    rows = [(i, f"t{i}", "en", "b" if i % 4 else "a", i) for i in range(120)]
    assert sorted(collected(M.build(spark.createDataFrame(rows, DOCUMENTS)).leaves), key=key) == sorted(manifest(rows), key=key)


def test_a_changed_text_breaks_its_own_proof_only(docs):
    changed = F.when(F.col("doc_id") == 20, F.concat(F.col("text"), F.lit("!"))).otherwise(F.col("text"))
    received = M.leaf([changed if c == "text" else F.col(c) for c in M.COLUMNS])
    out = M.build(docs, carry={"position": received}).leaves.toDF("doc_id", "received", "source", "place", "leaf", "proof", "subroot", "root")
    bad = out.where(M.fold(F.col("received"), F.col("proof")) != F.col("root")).select("doc_id").collect()
    assert {r[0] for r in bad} == {20} and len(bad) == 3


def test_empty_table_and_one_row(no_docs, spark):
    made = M.build(no_docs)
    assert made.leaves.count() == 0 and made.sources.count() == 0
    one = M.build(spark.createDataFrame([(1, "x", None, None, None)], DOCUMENTS)).leaves.first()
    assert one.root == one.leaf == one.subroot and one.proof == []
