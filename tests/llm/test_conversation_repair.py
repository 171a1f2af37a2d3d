"""Repairs against an enumeration of all edits of short conversations."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import conversation_repair as R
from strata.llm.queries_audit import QUERIES, damaged

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
GAPS = ["", "u", "a", "ua", "au", "uu", "aa"]


def faults(rows):
    """Rows in order with their first fault."""
    rows = sorted(((t, r or " ", x or (" " if x is None else "")) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, out = set(), []
    for turn, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "b" if not bare else "d" if (role, text) in seen else "k" if bare[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def enumerate_repairs(rows):
    """The cheapest edits of at most three rows, by trying all of them."""
    options = []
    for _, role, text, fault in rows:
        extra = 3 if fault == "t" else 0
        own = [("D", 4, "", None)]
        if fault not in "bd":
            own += [("K", extra, role[:1], (role, text)), ("R", 3 + extra, "u", ("user", text)), ("R", 3 + extra, "a", ("assistant", text))]
        options.append(own)
    best = None
    for acts in itertools.product(*options):
        for gaps in itertools.product(GAPS, repeat=len(rows) + 1):
            symbols = "".join(g + a[2] for g, a in zip(gaps, acts)) + gaps[-1]
            if not GRAMMAR.fullmatch(symbols):
                continue
            cost = sum(a[1] for a in acts) + 3 * sum(map(len, gaps))
            audit = "".join("I" * len(g) + a[0] for g, a in zip(gaps, acts)) + "I" * len(gaps[-1])
            if best is None or (cost, audit) < best[:2]:
                added = lambda g: [(R.ROLES[c], "") for c in g]
                turns = []
                for g, a in zip(gaps, acts):
                    turns += added(g) + ([a[3]] if a[3] else [])
                best = cost, audit, turns + added(gaps[-1])
    return best


def conversations(seed, n, most):
    rng = random.Random(seed)
    said = ["Yes.", "cut off", "", " \t", "Why?", "No!", "Well"]
    out = []
    for c in range(n):
        for _ in range(rng.randint(1, most)):
            turn = rng.choice([None, 0, 1, 2, 3, 7])
            out.append((c, turn, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None]), rng.choice([*said, None])))
    return out + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]


def by_conversation(rows):
    found: dict = {}
    for c, *rest in rows:
        found.setdefault(c, []).append(rest)
    return found


def results(made):
    report = {r.conv_id: r for r in made.report.collect()}
    turns: dict = {}
    for r in made.turns.orderBy("conv_id", "place").collect():
        assert r.place == len(turns.setdefault(r.conv_id, []))
        turns[r.conv_id].append((r.role, r.text))
    return report, turns


def test_against_all_edits(spark):
    rows = conversations(11, 60, 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).select("*", *(F.lit(1).alias(c) for c in ("position", "segment", "place", "row_id", "total", "fault")))
    report, turns = results(R.repair(df))
    expected = by_conversation(rows)
    assert set(report) == set(expected)
    for c, own in expected.items():
        marked = faults(own)
        cost, audit, repaired = enumerate_repairs(marked)
        r = report[c]
        assert (r.cost, r.audit, turns.get(c, [])) == (cost, audit, repaired), own
        kinds = "".join(m[3] for m in marked)
        assert (r.blank, r.duplicate, r.truncated) == (kinds.count("b"), kinds.count("d"), kinds.count("t"))
        known = [t for t, *_ in marked if t is not None]
        assert r.gaps == (max(known) - min(known) + 1 - len(set(known)) if known else 0)
        initials = [m[1][0] for m in marked]
        assert r.illegal == sum(a + b not in R.LEGAL for a, b in zip(initials, initials[1:]))


@pytest.mark.parametrize("segment", [2, 7])
def test_segments_give_the_same_repair(spark, segment):
    rows = conversations(5, 8, 60) + [(99, i, "user", f"{i}" + ".?x"[i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    whole, parts = results(R.repair(df)), results(R.repair(df, segment))
    assert whole == parts
    for c, turns in whole[1].items():
        assert GRAMMAR.fullmatch("".join(r[0] for r, _ in turns)), c


def test_a_long_conversation_keeps_linear_stacks():
    initials, marks = "ua" * 3000, "k" * 6000
    assert R.best(R.parse({0: (0, "")}, initials, marks)) == (0, "K" * 6000)
    assert len(R.inserted(R.parse({0: (0, "")}, "uua", "ktk"))) <= len(R.STACKS)


def test_empty_table(spark):
    made = R.repair(spark.createDataFrame([], SCHEMA))
    assert made.report.count() == 0 and made.turns.count() == 0


def test_query_reports_conversations_that_lost_all_rows(spark, tmp_path):
    rows = [(c, 0, "user", "Hello.") for c in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    left = {r.conv_id for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect()}
    out = {r.conv_id: r for r in QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    assert set(out) == set(range(60)) and len(left) < 60
    for c in set(out) - left:
        assert (out[c].cost, out[c].audit, out[c].gaps, out[c].repaired_sha256) == (0, "", 0, hashlib.sha256(b"").hexdigest())
