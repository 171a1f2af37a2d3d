import itertools
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import pii_crf as P

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


PARTS = ["a", "@", ".", "b.c", "1", "25", "255", "256", "0", "-", " ", "+", "(", ")", "%", "\n", "é", "４", "4111111111111111", "4111 1111 1111 1111", "+1 (551) 555-0826", "x@y.z", "1.2.3.4", "_"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=16).map("".join))
def test_base_spans_are_the_patterns_matches(text):
    assert P.base_spans(text) == brute(text)


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" + " " * 200_000, "0" * 5000 + ".1.2.3", ("a" * 50_000 + "@") * 4):
        P.base_spans(text)


def exact_beliefs(tokens, model):
    """Marginals by enumeration of all labellings."""
    local = model.local(tokens.features)
    n, labels = local.shape
    total = np.zeros((n, labels))
    for y in itertools.product(range(labels), repeat=n):
        if any(t and t != v for t, v in zip(tokens.labels, y)):
            continue
        score = sum(local[i, v] for i, v in enumerate(y)) + sum(model.chain[y[i], y[j]] for i, j in tokens.chain)
        total[range(n), y] += np.exp(score + sum(model.skip * (y[i] == y[j]) for i, j in tokens.skip))
    return total / total.sum(axis=1, keepdims=True)


def test_message_passing_is_exact_on_trees():
    rng = np.random.default_rng(2)
    for text in ("+1 (551) 555-0826 and 12.9", "x@y.z then 8 and later x@y.z", "5550826123 then again 5550826123 77"):
        tokens = P.tokens_of(text, P.base_spans(text))
        model = P.Model(rng.normal(size=(P.N_FEATURES, 5)), rng.normal(size=(5, 5)), 1.5)
        assert np.allclose(P.beliefs(tokens, model, 200), exact_beliefs(tokens, model), atol=2e-2)


def test_potentials_tie_distant_mentions(spark):
    rng = random.Random(4)
    phone = lambda: f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = []
    for i in range(300):
        p, q = phone(), f"name{i}.k@mail{i % 9}.example.com"
        rows.append((i, f"Call +1 {p} or write {q} . " + "plain words go on here " * 20 + f"3. again +1 {p} . Chapter {i % 20} has {q} inside"))
    p = "(640) 555-7741"
    rows += [
        (1000, f"Our number is +1 {p} today. " + "filler words " * 200 + f"Dial {p} tomorrow, chapter 12."),
        (1001, f"Dial {p} tomorrow, chapter 12."),
        (1002, "Version 2.0 of 17 items; nothing personal 640 times."),
        (1003, None),
        (None, ""),
    ]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, base int, spans int")
    found = {r["doc_id"]: r for r in P.find(docs, P.fit(docs)).collect()}
    spans = lambda i, c: [(s["kind"], dict(enumerate([r for r in rows if r[0] == i]))[0][1][s["start"] : s["end"]]) for s in found[i][c]]
    assert spans(1000, "base") == [("phone", f"+1 {p}")]
    assert ("phone", p) in spans(1000, "spans") or ("phone", p.lstrip("(")) in spans(1000, "spans")
    for i in (1001, 1002):  # nothing in the document to be consistent with
        assert spans(i, "base") == spans(i, "spans") == []
    assert found[1003]["spans"] == found[None]["spans"] == []
    for r in found.values():
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
        starts = [s["start"] for s in r["spans"]]
        assert starts == sorted(starts)


def test_held_out_labels_are_recovered():
    """Half of the documents train; in the others one of two equal mentions is
    hidden from the base spans and must be found by consistency."""
    rng = random.Random(6)
    make = lambda: f"see +1 (555) {rng.randint(200, 999)}-{rng.randint(1000, 9999)} and u{rng.randint(1, 99)}.x@mail{rng.randint(1, 9)}.example.com , item {rng.randint(1, 50)}"
    texts = [f"{(a := make())} " + "word " * 30 + a for _ in range(200)]
    model = P.train([P.tokens_of(t, P.base_spans(t)) for t in texts[:100]])
    hit = 0
    for t in texts[100:]:
        base = P.base_spans(t)
        hidden = base[-1]
        added = P.added_spans(t, base[:-1], model)
        hit += any(a <= hidden[0] and hidden[1] <= b and k == hidden[2] for a, b, k in added)
    assert hit >= 90


def test_empty_and_without_personal_data(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.fit(empty) is None and P.find(empty, None).collect() == []
    clean = spark.createDataFrame([(1, "no data here"), (2, "3 apples")], "doc_id long, text string")
    assert P.fit(clean) is None
    assert [r["spans"] for r in P.find(clean, P.fit(clean)).collect()] == [[], []]


def test_rare_personal_data_still_trains(spark):
    """Years make nearly every text a candidate; the few that hold base spans train all the same."""
    rows = [(i, f"written in {1900 + i % 100}, version {i}") for i in range(4000)]
    rows += [(5000 + i, f"write x{i}@mail.example.com or call +1 (551) 555-08{i:02d}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = lambda d, n: P.training_patterns(d, n).where("labelled").select("h").distinct().count()
    copies = docs.unionAll(docs.where("doc_id = 5003").crossJoin(spark.range(50)).drop("id"))
    assert [drawn(docs, 20), drawn(docs, 5), drawn(copies, 10)] == [12, 5, 10]
    assert P.fit(docs, 5) is not None


def test_loopy_documents_are_near_the_exact_marginals():
    rng = np.random.default_rng(8)
    text = "(640) 555-7741 a (640) 555-7741 b 640 5557741 c 12"
    tokens = P.tokens_of(text, [])
    assert len(tokens.chain) + len(tokens.skip) >= len(tokens.spans)  # has cycles
    for _ in range(5):
        model = P.Model(rng.normal(size=(P.N_FEATURES, 5)) / 2, rng.normal(size=(5, 5)) / 2, 0.8)
        assert np.abs(P.beliefs(tokens, model, 200) - exact_beliefs(tokens, model)).max() < 0.12


def test_numbers_in_other_groups_and_codes_are_tied():
    def tied(text):
        t = P.tokens_of(text, P.base_spans(text))
        return {tuple(sorted(text[slice(*t.spans[i])] for i in pair)) for pair in t.skip}

    assert ("78", "78") in tied("+33 6 12 34 56 78 or, later, 06 12 34 56 78")
    assert ("555-7741", "555-7741") in tied("+1 (640) 555-7741 and then (640) 555-7741")
    assert ("12", "12") in tied("section 12 and section 12")
    assert not tied("no 5557741 but 5557742")


def test_repeats_lack_country_codes():
    text = "a@b.co, +1 (640) 555-7741 x +33 6 12 34 56 78 y +44 20 7946-0958 c@d.co +15556667777"
    both, base = P.repeated(text, P.base_spans(text))
    assert both == text + "\na@b.co, 640-555-7741 x 6 12 34 56 78 y 20 7946-0958 c@d.co +15556667777"
    said = [both[a:b] for a, b, _ in base]
    assert said[6:] == ["a@b.co", "640-555-7741", "6 12 34 56 78", "20 7946-0958", "c@d.co", "+15556667777"]
    assert said[:6] == [text[a:b] for a, b, _ in P.base_spans(text)]


def planted(rng):
    phone = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    words = lambda n: " ".join(rng.choice(["plain", "words", "go", "on", "here"]) for _ in range(n))
    return phone, words


def test_planted_mentions_with_and_without_a_base_span(spark):
    rng = random.Random(12)
    rows = []
    for i in range(400):
        phone, words = planted(rng)
        rows.append((i, f"{words(9)} +1 {phone} {words(30)} chapter {i % 30} of {rng.randint(1900, 2020)} , version {i % 7}.{i % 4} {words(5)}"))
    for i in range(400, 800):
        _, words = planted(rng)
        n = rng.randint(100, 999)
        rows.append((i, f"{words(8)} {n} items, {words(9)} {n} again, year {1900 + i % 90} , pages {i}-{i + 9} {words(5)} version {i % 7}.{i % 4}.1"))
    model = P.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    hit = {True: 0, False: 0}
    for i in range(100):
        phone, words = planted(rng)
        for code in (True, False):
            text = f"{words(7)} {'+1 ' * code}{phone} {words(60)} dial {phone} today {words(4)} in {1950 + i % 60}"
            at = text.rindex(phone)
            added = P.added_spans(text, P.base_spans(text), model)
            hit[code] += any(a <= at + 1 and at + len(phone) <= b and k == 3 for a, b, k in added)
    assert min(hit.values()) >= 90, hit
    for plain in ("2003-05-12", "77123", "4.2.1", "12/04/1999", "1234567"):  # repeated, but no personal data
        assert not P.added_spans(f"on {plain} and later on {plain} again", [], model)
    clean = [P.added_spans(t, [], model) for _, t in rows[400:]]
    assert sum(map(bool, clean)) <= 8


def test_query_end_to_end(spark, docs, tmp_path):
    from hashlib import sha256

    from strata.llm.queries import QUERIES

    extra = [(900 + i, f"call +1 (640) 555-77{i:02d} , mail u{i}@m.example.com from 10.0.0.{i} ; 4111 1111 1111 1111") for i in range(30)]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] + extra
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op7_pii_crf"](spark, str(tmp_path)).collect()
    joined = lambda spans: ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, b, k in spans)
    want = sorted((str(d), *(sum(s[2] == k for s in brute(t or "")) for k in range(4)), sha256(joined(brute(t or "")).encode()).hexdigest()) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want
    texts = dict(rows)
    for r in got:
        assert set(filter(None, joined(brute(texts[r["doc_id"]] or "")).split(","))) <= set(r["spans"].split(","))
