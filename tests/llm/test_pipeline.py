"""The pipeline's stages, in turn, against the brute-force versions of their operators."""

from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from strata.config import scratch_path
from strata.llm import mixing, packing, quality_rules
from strata.llm.queries import tokenizer_file
from tests.llm.test_line_dedup import brute as without_boilerplate
from tests.llm.test_mixing import uniform, water
from tests.llm.test_quality_rules import verdicts
from tests.llm.test_simhash_index import components, plain


@pytest.fixture(scope="module")
def outputs(spark, docs):
    path = scratch_path(spark, "pipeline-input")
    df = docs.select("doc_id", "text", "lang", "source", "n_chars")
    out = []
    for _, stage in corpus_pipeline.STAGES:
        df.write.parquet(f"{path}/{len(out)}")
        df = spark.read.parquet(f"{path}/{len(out)}")
        out.append(df)
        df = stage(spark, df, path)
    out.append(df)
    return out


def texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def full(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_each_stage_on_its_own_input(outputs):
    for before, after, (name, _) in zip(outputs, outputs[1:-1], corpus_pipeline.STAGES):
        assert before.columns == after.columns, name
    judged = verdicts(full(outputs[0]), quality_rules.MIN_GROUP)
    assert Counter(r["doc_id"] for r in outputs[1].collect()) == Counter({i: n for (i, _, ok), n in judged.items() if ok})
    assert texts(outputs[2]) == without_boilerplate(full(outputs[1]), 10)
    prints = [(r[0], plain(r[1])) for r in full(outputs[2])]
    assert Counter(r["doc_id"] for r in outputs[3].collect()) == Counter({c for _, c in components(prints, 2)})
    sizes, want = defaultdict(int), Counter()
    for r in full(outputs[3]):
        sizes[r[3]] += len((r[1] or "").encode().split())
    target = water(sizes, mixing.WEIGHTS, mixing.MOST)
    for r in full(outputs[3]):
        rate = float(target[r[3]]) / sizes[r[3]] if sizes[r[3]] else 1.0
        want[r[0], r[1]] += int(rate) + (uniform(mixing.SEED, r[0]) < rate - int(rate))
    assert texts(outputs[4]) == +want
    pieces = outputs[5].collect()
    assert sum(r["start"] == 0 for r in pieces) == outputs[4].count()
    assert max(Counter(r["sequence_id"] for r in pieces).values()) > 1


def test_run_and_registration(spark, tmp_root, docs):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_root}/documents.parquet")
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, tmp_root).count() > 0


def test_empty(spark, tmp_root, no_docs):
    no_docs.write.parquet(f"{tmp_root}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_root).count() == 0


def test_sequences_come_from_the_result(spark, outputs):
    """The pieces kept by the last stage hold the ids of every mixed document."""
    encode = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")).encode
    want = Counter(i for r in outputs[4].collect() for i in [*encode(r["text"] or "", add_special_tokens=False).ids, 2])
    got = Counter()
    for r in packing.sequences(outputs[5]).collect():
        assert len(r["ids"]) == 4 * r["length"] <= 4 * packing.SEQUENCE
        got.update(int.from_bytes(r["ids"][k : k + 4], "little") for k in range(0, len(r["ids"]), 4))
    assert got == want
