import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import mixing as M


def water(sizes, weights, most):
    """Exact targets: cap, reshare, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        left = Fraction(sum(sizes.values()) - most * sum(sizes[s] for s in capped))
        shares = sum(weight[s] for s in names if s not in capped) or 1
        target = {s: Fraction(most * sizes[s]) if s in capped else left * weight[s] / shares for s in names}
        over = {s for s in names if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def plan(spark, sizes, **k):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    return {r["source"]: r for r in M.targets(df, **k).collect()}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1, "c": 5, "d": 40, "e": 0, None: 17}, {"x": 9}, {"x": 0, "y": 0}, {"b": 3, "ä": 3, "Z": 3, None: 3}, {},
    {f"s{i}": (i * 7919) % 50 for i in range(40)},
])
def test_targets_against_exact_arithmetic(spark, sizes):
    got, want = plan(spark, sizes), water(sizes, (1, 2, 3), 3)
    assert got.keys() == want.keys()
    for s, r in got.items():
        assert math.isclose(r["target"], want[s], rel_tol=1e-12, abs_tol=1e-12)


def uniform(seed, key):
    return int(hashlib.md5(f"{seed}:{'null' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52


def test_mix_against_brute_force(docs, rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += size(text)
    target, want = water(sizes, (1, 2, 3), 3), Counter()
    for doc_id, text, _, source, _ in rows:
        rate = float(target[source]) / sizes[source] if sizes[source] else 1.0
        want[doc_id, text] += math.floor(rate) + (uniform(M.SEED, doc_id) < rate - math.floor(rate))
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert got == +want
    assert got == Counter((r["doc_id"], r["text"]) for r in M.mix(docs.repartition(9)).collect())
    numbered = Counter((r["doc_id"], r["text"]) for r in M.emit(M.plan_mix(docs)).collect() if r["__copy"] is None)
    assert numbered == Counter({k: sum((r[0], r[1]) == k for r in rows) for k, n in want.items() if not n})
    planned = M.plan_mix(docs).collect()
    assert all(r["__size"] == size(r["text"]) and r["__copies"] <= 3 for r in planned)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(max_size=3), unique=True, max_size=30))
def test_sources_are_ranked_by_code_point(spark, names):
    names = [n for n in names if "\x00" not in n]
    df = spark.createDataFrame([(n, 1) for n in [*names, None]], "source string, source_size long")
    got = {r["source"]: r["rank"] for r in M.source_ranks(df).collect()}
    assert got == {n: i for i, n in enumerate([*sorted(names), None])}


def test_large_mix_meets_its_targets(spark):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 7}" if i % 3 else "hot") for i in range(20_000)]
    got = M.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source").agg({"__target": "max", "__source_size": "max"})
    taken = M.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).selectExpr("source", "__size * __copies AS t").groupBy("source").sum("t")
    goal = {r[0]: r["max(__target)"] for r in got.collect()}
    for source, t in taken.collect():
        assert abs(t - goal[source]) < 0.06 * goal[source]


def test_empty(no_docs):
    assert M.mix(no_docs).collect() == [] and M.plan_mix(no_docs).collect() == []
