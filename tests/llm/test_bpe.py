"""Encoding agrees with the tokenizer library, and decoding with its join of tokens."""

import hashlib
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from fundloom.llm import bpe
from fundloom.llm.catalog import QUERIES, WORD_BPE

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ODD = [
    "", "  ", "ΟΔΟΣ Σ ΑΣ", "<|startoftext|>Hi<|endoftext|> there<|endoftext", "İstanbul K ſ ǅ", "a\x1cb\x85c d​e　f",
    "é ́<|endoftext|>́a", "aaaaaaaaa ababababab 1234567 ½ ²٣ it's IT'S o're", "😀😀 👩‍👩‍👧 don''t ...!!!'s", "ßẞ ﬁ Å",
]


@pytest.fixture(scope="module")
def vocabulary():
    with open(WORD_BPE, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def ids_of(vocabulary, texts):
    ids, counts = bpe.Encoder(vocabulary).encode(texts)
    ends = counts.cumsum()
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts)]


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_odd_texts(vocabulary):
    assert ids_of(vocabulary, ODD) == [expected(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=60), min_size=1, max_size=5))
def test_any_text(vocabulary, texts):
    assert ids_of(vocabulary, texts) == [expected(t) for t in texts]


def test_query_equals_library(spark, sf_dir, local_documents):
    got = QUERIES["op8_bpe_round_trip"](spark, sf_dir).toPandas().set_index("doc_id")
    for doc_id, text in zip(local_documents.doc_id, local_documents.text):
        ids = expected(text or "")
        row = got.loc[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 2)
    encoder = bpe.Encoder(vocabulary)
    for text in ["one two three", "four five six one", "two seven"]:
        assert encoder.encode([text])[0].tolist() == expected(text)


def test_edges(edges, clashing, empty):
    rows = bpe.decode_documents(bpe.encode_documents(clashing, WORD_BPE), WORD_BPE).collect()
    assert len(rows) == edges.count()
    for r in rows:
        assert r.ids == expected(r.text or "") and r.n_tokens == len(r.ids) and r.slot == "own slot"
        assert r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False)
    assert bpe.encode_documents(empty, WORD_BPE).count() == 0


def test_decoding_passes_over_unknown_ids(spark):
    ids = spark.createDataFrame([([1, None, 10**6, -1, 2],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode_documents(ids, WORD_BPE).collect()] == ['" #', ""]


def test_keeping_pieces_of_the_last_texts(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    encoder = bpe.Encoder(vocabulary)
    for text in ["one two three four", "four it's <|endoftext|> one", "", "it's seven one", "two"]:
        assert encoder.encode([text])[0].tolist() == expected(text)
    assert set(encoder.pieces.place) <= {"", "it's", "seven", "one", "two"}


def test_parts_hold_every_value_in_order(monkeypatch):
    monkeypatch.setattr(bpe, "PART_BYTES", 8)
    texts = ["cut off", "abcd", None, "", "efgh", "a text longer than a part", "ÄÖ", "i", None]
    got = [p.to_pylist() for p in bpe.parts(pa.array(texts)[1:])]
    assert got == [["abcd", None, "", "efgh"], ["a text longer than a part"], ["ÄÖ", "i", None]]
    ids = [[1], None, [2], [3, None, 5], [], [6]]
    assert [p.to_pylist() for p in bpe.parts(pa.array(ids))] == [[[1], None, [2]], [[3, None, 5]], [[], [6]]]
    assert list(bpe.parts(pa.array([], pa.string()))) == []
    assert [len(p) for p in bpe.parts(pa.nulls(3))] == [3]


def test_columns_in_many_parts(spark, edges, monkeypatch):
    monkeypatch.setattr(bpe, "PART_BYTES", 64)
    monkeypatch.setattr(bpe, "KEPT_PIECES", 5)
    odd = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None] * 3)], "doc_id long, text string").coalesce(2)
    for docs in (odd, edges):
        rows = bpe.round_trip_documents(docs, WORD_BPE).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.ids == expected(r.text or "") and r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False)
        apart = bpe.decode_documents(bpe.encode_documents(docs, WORD_BPE), WORD_BPE)
        assert sorted(map(repr, apart.collect())) == sorted(map(repr, rows))


def test_memory_follows_the_part_not_the_batch(vocabulary):
    texts = pa.array([" ".join(f"w{j % 997}" for j in range(i, i + 4000)) for i in range(300)])
    peaks, counts = [], []
    for batches in ([texts], bpe.parts(texts)):
        encoder = bpe.Encoder(vocabulary)
        tracemalloc.start()
        counts.append(sum(len(bpe._encoded(encoder, part)[0]) for part in batches))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert counts[0] == counts[1] and peaks[1] < peaks[0] / 2


def test_a_large_batch_is_passed_on_in_parts():
    called = []
    texts = pa.array([" ".join(f"w{i}" for i in range(200_000))] * 3)
    with open(WORD_BPE, encoding="utf-8") as f:
        definition = f.read()
    for _ in bpe._round_trips(definition, iter([texts])):
        called.append(1)
    bpe.give_back()
    assert len(called) == 3  # texts of over half a part
