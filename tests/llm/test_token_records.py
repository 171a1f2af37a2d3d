import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.config import scratch_path
from strata.llm import token_records as R
from strata.llm.queries import tokenizer_file
from strata.llm.tokenization import PieceEncoder

PARTS = ["a", "Word", " ", "  ", "\n", " \n", "\t", "é", "é", "́", "　", " ", "'s", "12", "!", ",", "<|endoftext|>", "\x1c", "᠎", "İ", "Σ", "\x00", "​", "x y", "\x85"]


@pytest.fixture(scope="module")
def encoders():
    return [PieceEncoder(tokenizer_file("byte_bpe_50k.json"), True), PieceEncoder(tokenizer_file("word_bpe_49k.json"), False)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join) | st.text(max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(encoders, text):
    for e in encoders:
        assert e.widen(e.encode(text)).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.integers(-(2**63), 2**63 - 1) | st.none(), st.binary(max_size=60))
def test_frame_round_trip(doc_id, ids):
    assert R.unframe(R.frame(doc_id, ids)) == (doc_id, ids)


@given(st.binary(min_size=2, max_size=40), st.data())
def test_any_damaged_byte_is_noticed(ids, data):
    record = bytearray(R.frame(3, ids))
    record[data.draw(st.integers(0, len(record) - 1))] ^= 1 << data.draw(st.integers(0, 7))
    with pytest.raises(ValueError):
        R.unframe(bytes(record))


def test_files_hold_the_ids_in_document_order(spark, docs, rows, encoders):
    folder = scratch_path(spark, "test-records")
    index = R.write_records(docs, folder, tokenizer_file("byte_bpe_50k.json"))
    read = R.read_records(index).join(R.file_starts(index), "part").collect()
    got = sorted((r["ids_before_file"] + r["tokens_before"], r["doc_id"], zlib.crc32(r["ids"])) for r in read)
    want, at = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for doc_id, text, *_ in order:
        ids = encoders[0].encode(text or "") + (2).to_bytes(2, "little")
        want.append((at, doc_id, zlib.crc32(ids)))
        at += len(ids) // 2
    assert got == want


def test_shuffled_and_partial_reads_use_the_index(spark, docs):
    folder = scratch_path(spark, "test-records")
    index = R.write_records(docs, folder, tokenizer_file("byte_bpe_50k.json"))
    every = {(r["part"], r["position"]): bytes(r["ids"]) for r in R.read_records(index).collect()}
    mixed = R.read_records(R.shuffled(index, 1)).collect()
    assert {(r["part"], r["position"]): bytes(r["ids"]) for r in mixed} == every
    again = R.shuffled(index, 1).collect()
    assert again == R.shuffled(index, 1).collect() != R.shuffled(index, 2).collect()
    some = random.Random(2).sample(sorted(every), 5)
    picked = index.where(" OR ".join(f"(part = {p} AND position = {n})" for p, n in some))
    assert {(r["part"], r["position"]): bytes(r["ids"]) for r in R.read_records(picked).collect()} == {k: every[k] for k in some}


def test_empty(spark, no_docs):
    index = R.write_records(no_docs, scratch_path(spark, "test-records"), tokenizer_file("byte_bpe_50k.json"))
    assert index.count() == 0 and R.read_records(index).collect() == []


LINES = ["a", "Word", " ", "\n", "\n\n", "é.", "Ü", "x!!", "***", "'s", "!'", "12", "<|endoftext|>", "|>", " DE!!", "ª", "²", "$%", "\x0b", "　", "\x1c", "́", "ÿ:"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(LINES), max_size=10).map("".join))
def test_lines_and_runs_of_signs_give_the_ids_of_the_whole_text(encoders, text):
    for e in encoders:
        want = e.tokenizer.encode(text, add_special_tokens=False).ids
        assert [e.widen(e.encode(text)).tolist() for _ in range(3)] == [want] * 3


def test_a_line_feed_is_a_piece_of_its_own_and_a_piece_met_once_is_not_kept(encoders):
    e = PieceEncoder(tokenizer_file("byte_bpe_50k.json"), True)
    assert e.pieces("One two.\nThree é\nfour\n") == ["One", " two.", "\n", "Three", " é", "\n", "four", "\n", ""]
    assert e.pieces("One \ntwo") == ["One", " \ntwo"]
    words = [f" w{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(600)]
    e.encode("".join(words))
    assert len(e.memory) < 10
    e.encode("".join(words[:300]))
    assert 300 <= len(e.memory) < 310
