"""Byte-level BPE against the tiktoken library, and the round trip of decoding."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from liftlens.llm import bpe

from .conftest import odd_rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = bpe.Vocabulary.read(PATH)
LIBRARY = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN,
                            mergeable_ranks=VOCABULARY.ranks, special_tokens={})
ODD = ["'", "'", "s", "t", "r", "e", "v", "l", "l", "m", "d", " ", " ", "\n", "\t", " ",
       " ", "\u0085", "a", "é", "中", "1", "²", "!", "́", "S", "😀", "'ll", "'re", "\x1c"]


def _encode(texts):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    ids, ends, first = bpe.Encoder(VOCABULARY).encode(
        np.frombuffer(b"".join(data), np.uint8), offsets)
    for i, raw in enumerate(data):
        part = slice(first[i], first[i + 1])
        assert bpe.place_tokens(ids[part].astype(np.int64), ends[part], VOCABULARY) == raw
    return [ids[first[i]:first[i + 1]].tolist() for i in range(len(texts))]


def _same(texts):
    assert _encode(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_symbols_of_all_code_points_are_the_library_s():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    single = {bytes([b]): b for b in range(256)}
    of = {bpe.NUMBER: r"\p{N}", bpe.WHITE: r"\s", bpe.LETTER: r"\p{L}"}
    kinds = VOCABULARY.symbols.copy()
    kinds[kinds == bpe.SPACE] = bpe.WHITE
    kinds[np.isin(kinds, (bpe.ONE, bpe.R_OR_V, bpe.ELL, bpe.E))] = bpe.LETTER
    kinds[0xD800:0xE000] = bpe.OTHER
    for symbol, pattern in of.items():
        only = tiktoken.Encoding("one", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(only.encode_ordinary(text)).decode()
        assert np.flatnonzero(kinds == symbol).tolist() == [ord(c) for c in found]


def test_compositions_are_those_of_the_symbols():
    rnd = random.Random(1)
    for _ in range(200):
        symbols = [rnd.randrange(bpe.SYMBOLS) for _ in range(rnd.randint(1, 9))]
        number, state = symbols[0], list(range(bpe.STATES))
        for y in symbols[1:]:
            number = bpe.COMPOSED[number, y]
        for y in symbols:
            state = [bpe._step(s, y)[0] for s in state]
        assert bpe.FUNCTIONS[number].tolist() == state


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 5_000])
def test_scan_is_the_automaton_step_by_step(n):
    rnd = random.Random(n)
    symbols = np.array([rnd.randrange(bpe.SYMBOLS) for _ in range(n)], np.uint8)
    state, expected = bpe.FRESH, []
    for y in symbols.tolist():
        state, starts = bpe._step(state, y)
        expected.append(starts)
    assert bpe.scan(symbols).tolist() == expected


def test_odd_texts_are_encoded_as_by_the_library():
    rnd = random.Random(2)
    for _ in range(1_500):
        _same(["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14))) for _ in range(4)])
    _same(["", "a" * 5_000, "ab" * 3_000, "!" * 777 + "x", " " * 900, "'s's'll'LL're''s",
           "<|endoftext|>", "".join(rnd.choice("abcdefgh") for _ in range(20_000))])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text_is_encoded_as_by_the_library(texts):
    _same([t.encode("utf-8", "replace").decode() for t in texts])


def test_long_texts_are_cut_where_a_slice_starts():
    rnd = random.Random(3)
    text = "".join(rnd.choice(ODD) for _ in range(20_000)) + "x" * 3_000 + "   y"
    data = np.frombuffer(text.encode(), np.uint8)
    expected = LIBRARY.encode_ordinary(text)
    for limit in (1, 50, 4_096):
        ids, ends, _ = bpe.Encoder(VOCABULARY).encode_long(data, limit)
        assert ids.tolist() == expected
        assert bpe.place_tokens(ids.astype(np.int64), ends, VOCABULARY) == text.encode()
    assert len(list(bpe._parts(data, 50))) > 100


def test_merging_by_heap_is_merging_by_scan():
    rnd = random.Random(4)
    for _ in range(300):
        piece = "".join(rnd.choice("aehtson é中") for _ in range(rnd.randint(1, 60))).encode()
        assert bpe._merge_heap(piece, VOCABULARY.ranks) == bpe._merge_scan(piece, VOCABULARY.ranks)


def test_wrong_ends_are_an_error():
    ids = np.array([VOCABULARY.ranks[b"a"], VOCABULARY.ranks[b"b"]])
    with pytest.raises(ValueError, match="ends"):
        bpe.place_tokens(ids, np.array([1, 3], np.uint32), VOCABULARY)


def _digest(doc_id, text):
    ids = LIBRARY.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def _key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def test_query_on_odd_rows(spark, odd_dir):
    got = [tuple(r) for r in bpe.op12_bpe(spark, odd_dir).collect()]
    assert sorted(got, key=_key) == sorted((_digest(r[0], r[1]) for r in odd_rows()), key=_key)


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert {tuple(r) for r in bpe.op12_bpe(spark, sf).collect()} == {_digest(*r) for r in docs}


def test_empty_table_and_small_chunks(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, PATH, ["doc_id"]), PATH, ["doc_id"]).collect() == []
    # names of the operator's own columns, and chunks smaller than the texts
    rows = [(i, f"it's {i} words  of\n text 中文 " * i, b"x", "y", "z") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary, ends string, decoded string")
    encoded = bpe.encode(docs, PATH, ["doc_id"], limit=16)
    got = {r.doc_id: (np.frombuffer(r.ids, "<u4").tolist(), np.frombuffer(r.ends, "<u4"))
           for r in encoded.collect()}
    assert {i: ids for i, (ids, _) in got.items()} == {
        r[0]: LIBRARY.encode_ordinary(r[1]) for r in rows}
    assert {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode(encoded, PATH, ["doc_id"]).collect()
            } == {r[0]: r[1] for r in rows}
