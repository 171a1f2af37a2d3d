from collections import Counter, defaultdict

import pytest

from strata.llm import line_dedup as L

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, least):
    sites, first = defaultdict(set), {}
    for doc_id, text, _, source, _ in rows:
        for i, line in enumerate((text or "").split("\n")):
            if key := line.strip(SPACE):
                sites[key].add(source)
                at = (doc_id is None, doc_id or 0, i)
                first[key] = min(first.get(key, at), at)
    out = []
    for doc_id, text, _, _, _ in rows:
        if text is None:
            out.append((doc_id, None))
            continue
        keep = []
        for i, line in enumerate(text.split("\n")):
            key = line.strip(SPACE)
            if not key or len(sites[key]) < least or first[key] == (doc_id is None, doc_id or 0, i):
                keep.append(line)
        out.append((doc_id, "\n".join(keep)))
    return Counter(out)


@pytest.mark.parametrize("least", [2, 4, 9])
def test_against_brute_force(docs, rows, least):
    out = L.drop_boilerplate(docs, min_sites=least)
    assert out.columns == docs.columns
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == brute(rows, least)
    changed = {r["doc_id"]: r for r in got if r["text"] is not None and (r["doc_id"], r["text"]) not in {(x[0], x[1]) for x in rows}}
    assert changed and all(r["n_chars"] == len(r["text"]) for r in changed.values())


def test_near_threshold_lines_are_counted_exactly(spark):
    """Sketches of 16 registers are far off; the band sends the lines to the exact count."""
    rows = [(i, "the line\nown words of %d" % i, "en", f"site{i}", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lines = L.lines(docs)
    for least, found in ((60, 1), (61, 0)):
        assert L.boilerplate(lines, least, near=0.9, lg_k=4).count() == found


def test_slices_between_removed_positions(spark):
    rows = [(list("abcde"), r) for r in ([], [0], [4], [1, 3], [3, 1], [0, 1, 2, 3, 4], [2])] + [([""], [0]), ([""], []), (["", "x", ""], [1])]
    df = spark.createDataFrame(rows, "lines array<string>, removed array<int>")
    for r in df.select("*", L.without(L.F.col("lines"), L.F.col("removed")).alias("kept")).collect():
        assert r["kept"] == [x for i, x in enumerate(r["lines"]) if i not in r["removed"]]


def test_long_texts_take_time_by_their_lines(spark):
    """Texts of 100,000 lines, all but every fourth shared by twelve sites."""
    from time import monotonic

    def run(lines):
        body = lambda d: "\n".join(f"line {i}" if i % 4 else f"own {d} {i}" for i in range(lines))
        docs = spark.createDataFrame([(d, body(d), "en", f"s{d}", 1) for d in range(12)], "doc_id long, text string, lang string, source string, n_chars long")
        start = monotonic()
        out = L.drop_boilerplate(docs, marks=True).select("doc_id", "__n_removed", L.F.size(L.F.split("text", "\n", -1)).alias("n")).collect()
        took = monotonic() - start
        assert {(r["doc_id"], r["__n_removed"], r["n"]) for r in out} == {(d, lines * 3 // 4 if d else 0, lines // 4 if d else lines) for d in range(12)}
        return took

    run(1000)
    short, long = run(10_000), run(100_000)
    assert long < 20 * short  # ten times the lines; quadratic would be a hundred times


def test_a_hot_line_is_one_sketch_a_task(docs):
    plan = L.lines(docs).groupBy("h1", "h2").agg(L.F.hll_sketch_agg("site", 12))._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan and "Python" not in plan


def test_empty(no_docs):
    out = L.drop_boilerplate(no_docs, marks=True)
    assert out.collect() == [] and out.columns == [*no_docs.columns, "__n_lines", "__n_removed"]
