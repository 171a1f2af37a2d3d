import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import chat_trees as C

SCHEMA = "tree_id long, msg_id long, parent_id long, role string, text string, score double"
TRICKY = ["<", "[", "\\", "|im_start|>", "|im_end|>", "s>", "/s>", "INST]", "/INST]", "\n", "x", "<|im_end|>\n", "[/INST]", "é"]


def brute(rows, best):
    """Root-to-leaf paths by walking, ranked by mean score, longer first, then leaf."""
    nodes = {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3] or "", r[4] or "", r[5] is not None, r[5] or 0)):
        nodes.setdefault(r[:2], r)
    parent = {k: (k[0], r[2]) if r[2] is not None and r[2] != k[1] and (k[0], r[2]) in nodes else None for k, r in nodes.items()}
    inner = {p for p in parent.values() if p}
    found = {}
    for leaf in nodes.keys() - inner:
        path, at = [], leaf
        while at and at not in path:
            path.append(at)
            at = parent[at]
        if at is None:
            found.setdefault(leaf[0], []).append(path[::-1])
    out = {}
    for tree, paths in found.items():
        paths.sort(key=lambda p: (-sum(nodes[n][5] or 0 for n in p) / len(p), -len(p), p[-1][1]))
        for rank, path in enumerate(paths[:best], 1):
            out[tree, path[-1][1]] = (rank, [(nodes[n][3] or "", nodes[n][4] or "") for n in path])
    return out


def forest(seed):
    rng, rows = random.Random(seed), []
    for tree in (1, 2, None, 9):
        size = 60 if tree == 9 else rng.randint(1, 25)
        for m in range(size):
            up = rng.choice([None, m, 999]) if m == 0 or rng.random() < 0.1 else (m - 1 if tree == 9 else rng.randrange(m))
            text = rng.choice([None, "", "".join(rng.choice(TRICKY) for _ in range(rng.randint(0, 6)))])
            rows.append((tree, m, up, rng.choice(["user", "assistant", None, "a\\n\nb", "[INST]"]), text, rng.choice([None, 0.5, 1.0, 2.0])))
    rows += [(2, 500, 501, "user", "cycle", 1.0), (2, 501, 500, "user", "cycle", 1.0), (2, 502, 500, "user", "below it", 1.0)]
    return rows + rows[:3]


def test_paths_ranks_and_formats_against_brute_force(spark):
    for seed, best in ((2, 3),):
        rows = forest(seed)
        df = spark.createDataFrame(rows, SCHEMA).withColumn("height", F.lit(1)).withColumn("leaf", F.lit("x"))
        out = C.format_trees(df, best).withColumn("turns", C.parse(F.col("formatted"))).withColumn("loss", C.loss_text(F.col("formatted"), F.col("loss_spans")))
        got = {(r["tree_id"], r["leaf"]): (r["rank"], [tuple(t) for t in r["turns"]]) for r in out.collect()}
        want = brute(rows, best)
        assert got == want
        for r in out.collect():
            turns = want[r["tree_id"], r["leaf"]][1]
            assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
            assert r["formatted"].count(C.START) == r["formatted"].count(C.END) == len(turns)
            for s in ("</s>", "[INST]", "[/INST]", "<s>"):
                assert s not in r["formatted"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(TRICKY), max_size=12).map("".join), min_size=1, max_size=40))
def test_escape_round_trip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escape(F.col("t")).alias("e"), C._unescape_role(C._escape_role(F.col("t"))).alias("r"))
    for r in df.select("t", "e", "r", C.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"] == r["r"]
        assert not any(c in r["e"] for c in C.CONTROL)


def test_rounds_are_logarithmic(spark):
    chain = [(1, i, i - 1 if i else None, "user", f"t{i}", 1.0) for i in range(70)]
    tables, unrooted = C.jump_tables(C.messages_of(spark.createDataFrame(chain, SCHEMA)))
    assert len(tables) == 7 and unrooted is None


def test_conversations_are_ordered_by_turn_and_ties_are_kept(spark):
    rows = [(5, 2, "assistant", "b", 1), (5, 1, "user", None, 1), (5, 2, "assistant", "a", 1), (6, 1, None, "z", 1), (5, 2, "assistant", "a", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, msg_id int")
    out = C.format_trees(C.chain_messages(df)).select("tree_id", C.parse(F.col("formatted")).alias("t")).collect()
    assert {r["tree_id"]: [tuple(t) for t in r["t"]] for r in out} == {
        5: [("user", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")], 6: [("", "z")],
    }


def test_empty(spark):
    assert C.format_trees(spark.createDataFrame([], SCHEMA)).collect() == []
