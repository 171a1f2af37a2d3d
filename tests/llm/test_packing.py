import random
import zlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import packing as P
from strata.llm.queries import q_packing, tokenizer_file

FILE = tokenizer_file("word_bpe_49k.json")


def plain_first_fit(lengths, capacity):
    bins, out = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, used in enumerate(bins) if used + lengths[i] <= capacity), len(bins))
        if b == len(bins):
            bins.append(0)
        out[i] = (b, bins[b])
        bins[b] += lengths[i]
    return out


@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_tournament_is_first_fit_decreasing(case):
    capacity, lengths = case
    assert P.first_fit_decreasing(lengths, capacity) == plain_first_fit(lengths, capacity)


def test_every_id_lies_in_one_place(docs, rows, spark):
    tokenizer = Tokenizer.from_file(FILE)
    for sequence, group in ((64, 500), (4096, 2_000_000)):
        out = P.pack_documents(docs, FILE, sequence=sequence, group_tokens=group).collect()
        held, texts = defaultdict(list), defaultdict(int)
        for r in out:
            assert len(r["ids"]) == 4 * r["length"]
            held[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in held.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= sequence
        for doc_id, text, *_ in rows:
            texts[doc_id, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (2,)] += 1
        joined = defaultdict(int)
        by_doc = defaultdict(lambda: defaultdict(list))
        for r in out:
            by_doc[r["doc_id"], r["doc_tokens"]][r["start"]].append(bytes(r["ids"]))
        for (doc_id, total), starts in by_doc.items():
            times = len(starts[0])  # repeated rows
            for k in range(times):
                ids = b"".join(starts[s][k] for s in sorted(starts))
                assert len(ids) == 4 * total
                joined[doc_id, tuple(int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4))] += 1
        assert joined == texts
        total = sum(r["length"] for r in out)
        groups = len({i >> 32 for i in held})
        assert len(held) <= total / sequence * 1.05 + groups + 1


def test_sequences_concatenate_their_pieces(docs):
    packed = P.pack_documents(docs, FILE, sequence=64, group_tokens=900)
    want = defaultdict(dict)
    for r in packed.collect():
        want[r["sequence_id"]][r["offset"]] = bytes(r["ids"])
    for r in P.sequences(packed, 64).collect():
        parts = want.pop(r["sequence_id"])
        assert bytes(r["ids"]) == b"".join(parts[k] for k in sorted(parts)) and len(r["ids"]) == 4 * r["length"]
        assert r["padded_length"] == (r["length"] if r["length"].bit_count() == 1 else 64)
    assert not want


def test_little_padding(spark):
    rng = random.Random(3)
    lengths = [min(4096, int(rng.expovariate(1 / 500)) + 1) for _ in range(6000)]
    parts = spark.createDataFrame([(n, rng.getrandbits(62)) for n in lengths], "length long, place long")
    held = P.pack(parts, group_tokens=500_000).select("sequence_id").distinct().count()
    assert held * 4096 <= sum(lengths) * 1.01 + 4096 * 7


def test_empty(no_docs):
    out = P.pack_documents(no_docs, FILE)
    assert out.collect() == [] and "sequence_id" in out.columns


def test_the_query_reads_the_packed_ids(spark, tmp_root, docs, monkeypatch):
    """An error in carrying ids with their piece shows in length and checksum."""
    docs.select("doc_id", "text").write.parquet(f"{tmp_root}/documents.parquet")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    want = sorted(map(str, P.pack_documents(docs, FILE).withColumn("ids_crc32", F.crc32("ids")).select(*columns).collect()))
    assert sorted(map(str, q_packing(spark, tmp_root).select(*columns).collect())) == want
    real = P.pack_documents
    monkeypatch.setattr(P, "pack_documents", lambda *a, **k: real(*a, **k).withColumn("ids", F.unhex(F.lit("0500000006000000"))))
    ids = (5).to_bytes(4, "little") + (6).to_bytes(4, "little")
    assert {(r["length"], r["ids_crc32"]) for r in q_packing(spark, tmp_root).collect()} == {(2, zlib.crc32(ids))}
