import math
import re
from collections import Counter, defaultdict

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


@given(st.lists(st.sampled_from(["a", "b", "#x", "\n", " ", "\t", "\x0b", "é|", "　"]), max_size=60).map("".join))
def test_counts(text):
    assert Q.base_counts(text) == counts(text) and Q.ratio_counts(text)[1] == counts(text)[:4]


def test_no_text_is_shuffled(docs):
    plan = Q.drop_low_quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def cell(v):
    shift = max(v.bit_length() - 8, 0)
    return v >> shift << shift


def verdicts(rows, least):
    data = [(*counts(r[1]), r[2], r[3]) for r in rows]
    values = defaultdict(list)
    for n, chars, sym, dup, _, lang, source in data:
        if n:
            for name, v in (("symbols", sym), ("word_length", chars), ("dup_lines", dup)):
                for group in ((lang, source), (lang,)):
                    values[group, name].append(cell(v * 1000 // n))

    def quartiles(lang, source, name):
        v = sorted(values[(lang, source), name])
        if len(v) < least:
            v = sorted(values[(lang,), name])
        return v[math.ceil(len(v) / 4) - 1], v[math.ceil(3 * len(v) / 4) - 1]

    out = []
    for r, (n, chars, sym, dup, rep, lang, source) in zip(rows, data):
        failed = n < 10 or 100 * rep > 20 * n
        ok = not failed
        for name, have, spread, slack in (("symbols", sym, 33, 20), ("word_length", chars, 1000, 50), ("dup_lines", dup, 10, 100)) if ok else ():
            low, high = quartiles(lang, source, name)
            room = 3 * max(high - low, spread) * (n + slack)
            ok = ok and have * 1000 - high * n <= room and (name != "word_length" or low * n - have * 1000 <= room)
        out.append((r[0], failed, ok))
    return Counter(out)


def test_against_brute_force(docs, rows):
    for least in (5, 100):
        got = Q.judge(docs, least)
        assert Counter((r["doc_id"], r["__base_failed"], r["__kept"]) for r in got.collect()) == verdicts(rows, least)
    kept = Q.drop_low_quality(docs, 5)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({k: 0 for k in ()}) + Counter(
        {i: n for (i, _, ok), n in verdicts(rows, 5).items() if ok}
    )


def test_sketches_merge_exactly_and_are_close(spark):
    values = [int(1.07**i) + i for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", Q.sketch_cell(F.col("v")).alias("c"))
    for r in df.collect():
        assert r["c"] == cell(r["v"]) and 0 <= r["v"] - r["c"] <= r["v"] / 128


def test_empty(no_docs):
    assert Q.judge(no_docs).collect() == [] and Q.drop_low_quality(no_docs).columns == no_docs.columns
