import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from strata.llm import backoff_lm as B

COLUMNS = "doc_id long, text string, block int, words string"


def brute(docs, order):
    """Stupid backoff under the counts of all other documents, word by word."""
    split = [(t or "").encode().split() for t in docs]
    grams = lambda w: Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    every = sum((grams(w) for w in split), Counter())
    total = sum(map(len, split))
    out = []
    for w in split:
        own = grams(w)
        c = lambda g: every[g] - own[g]  # noqa: E731, B023
        score = longest = unseen = 0
        for i in range(len(w)):
            p, n = None, order
            while p is None and n > 1:
                g = tuple(w[i - n + 1 : i + 1]) if i - n + 1 >= 0 else None
                if g and c(g) > 0:
                    p = c(g) / c(g[:-1])
                else:
                    n -= 1
            if p is None:
                one = c((w[i],))
                p = (one if one > 0 else 0.5) / max(total - len(w), 1)
                unseen += one <= 0
            score += round((math.log(p) + (order - n) * math.log(0.4)) * 1e6)
            longest += n == order
        out.append((len(w), score, longest, unseen))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(spark, rows, order):
    texts = [r[1] for r in rows]
    df = spark.createDataFrame([(i if i != 4 else None, t, 1, "x") for i, t in enumerate(texts)], COLUMNS).repartition(3)
    want = dict(enumerate(brute(texts, order)))
    want[None] = want.pop(4)
    for block, bucket in ((4_000_000, 8_000_000), (900, 300)):  # one block, many small ones
        got = {r[0]: tuple(r[1:]) for r in B.document_scores(df, order, block, bucket).collect()}
        assert got.keys() == want.keys()
        for k, (n, score, longest, unseen) in got.items():
            assert (n, longest, unseen) == (want[k][0], *want[k][2:])
            assert abs(score - want[k][1]) <= 1  # a rounding of a millionth may fall either way


def test_blocks_are_bounded_and_hold_every_row(spark):
    df = spark.createDataFrame([(i, "w " * (i % 9 * 40), 1, "x") for i in range(200)], COLUMNS)
    blocks = B.blocks_of(df, 1000).collect()
    assert sum(len(b["lengths"]) for b in blocks) == 200 and len(blocks) > 20
    assert all(sum(b["lengths"]) <= 500 for b in blocks)


def test_a_common_gram_is_one_entry_a_block(spark):
    df = spark.createDataFrame([(i, "the same words", 1, "x") for i in range(300)], COLUMNS).coalesce(1)
    asked = B.requests(B.blocks_of(df, 1000), 2, 4).collect()
    assert sum(len(B.unsqueeze_sorted(r["keys"])) for r in asked) == 5 * len({r["block"] for r in asked})


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50), st.lists(st.integers(-(2**63), 2**63 - 1), max_size=50))
def test_squeezing_loses_nothing(keys, numbers):
    keys = np.unique(np.array(keys, dtype=np.uint64))
    assert (B.unsqueeze_sorted(B.squeeze_sorted(keys)) == keys).all()
    for dtype in (np.int64, np.uint32):
        values = np.array(numbers, dtype=np.int64).astype(dtype)
        assert B.unsqueeze(B.squeeze(values), dtype).tolist() == values.tolist()


def test_edges(spark):
    assert B.document_scores(spark.createDataFrame([], COLUMNS)).collect() == []
    alone = B.document_scores(spark.createDataFrame([(1, "only one", 1, "x")], COLUMNS)).first()
    assert (alone["n_words"], alone["n_unseen"]) == (2, 2)
    empty = B.document_scores(spark.createDataFrame([(1, None, 1, "x"), (2, "", 1, "x")], COLUMNS)).collect()
    assert sorted(tuple(r) for r in empty) == [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0)]
