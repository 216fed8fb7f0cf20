"""Counts, packing and files against the library on whole texts."""

import functools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from careloom.llm import encoding, packing, queries, runtime, token_counts, token_files
from tests.conftest import SMALL
from tests.llm.conftest import pairs

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.lists(st.sampled_from(list("aAbé,.!'3 \n\t  ́\x1c<|>ß한É") + ["the ", " of", "<|endoftext|>", "   ", "it's"]), max_size=40).map("".join)


@functools.cache
def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def word():
    return library(WORD)


@pytest.fixture(scope="module")
def byte():
    return library(BYTE)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_pieces_are_as_good_as_whole_texts(texts):
    word, byte = library(WORD), library(BYTE)
    ids, lengths = encoding.of_worker(encoding.TextIds, WORD), encoding.of_worker(encoding.TextLengths, BYTE)
    as_bytes = [t.encode() for t in texts]
    assert [np.frombuffer(ids.ids(t), "<u2").tolist() for t in as_bytes] == [word(t) for t in texts]
    assert lengths.count(as_bytes) == [len(byte(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 12))
def test_segments(text, size):
    byte, parts = library(BYTE), list(runtime.segments(text.encode(), size))
    assert b"".join(parts) == text.encode()
    if "<|" not in text:
        assert sum(len(byte(p.decode())) for p in parts) == len(byte(text))


def test_memory_forgets(word):
    ids = encoding.TextIds(WORD, 6)
    for text in ("a b c d e f g", "h i j k", "a. b, c.", "zz zz. zz,", "a b h zz"):
        assert np.frombuffer(ids.ids(text.encode()), "<u2").tolist() == word(text)


def test_memory_is_bounded(word):
    few, small = encoding.TextIds(WORD, 100), encoding.TextIds(WORD, 10**6, 3000)
    short = " ".join(f"{chr(97 + n % 26)}{chr(97 + n // 26)}x, {n}" for n in range(600))
    long = " ".join("ab" * 20 + str(n) for n in range(300)) + " " + "cd" * 5000
    for ids in (few, small):
        for text in (short, long, short):
            assert np.frombuffer(ids.ids(text.encode()), "<u2").tolist() == word(text)
            held = {**ids.known.before, **ids.known}
            assert len(held) <= 100 or ids is small
            assert sum(len(w) + len(v) for w, v in held.items()) <= 3000 or ids is few


def test_counts(spark, docs, byte):
    got = {tuple(r) for r in queries.op2_token_counts(spark, SMALL).collect()}
    expected = {(d, len(t.encode()), len(byte(t)), len(byte(t)) > 512) for d, t in pairs(docs)}
    assert got == expected


def test_odd_counts(odd, none, byte, word):
    for path, count in ((BYTE, byte), (WORD, word)):
        got = sorted((tuple(r) for r in token_counts.count_tokens(odd, path, 5).collect()), key=repr)
        expected = [(d, len((t or "").encode()), len(count(t)), len(count(t)) > 5) for d, t in pairs(odd)]
        assert got == sorted(expected, key=repr)
    assert token_counts.count_tokens(none, BYTE, 5).collect() == []


def test_counts_of_a_sentencepiece_model(odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted(((r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(odd, path, 5).collect()), key=repr)
    assert got == sorted(((d, len(model.encode(t or ""))) for d, t in pairs(odd)), key=repr)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 25), st.integers(1, 4), max_size=6), st.integers(0, 40))
def test_fill_is_closest(counts, target):
    reach = {0}
    for n, c in counts.items():
        reach |= {r + n * k for r in reach for k in range(1, c + 1)}
    used = packing.fill(target, counts)
    assert all(c <= counts[n] for n, c in used.items())
    assert sum(n * c for n, c in used.items()) == max(r for r in reach if r <= target)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 15), st.integers(1, 50), max_size=8))
def test_places_fill_windows(counts):
    places = packing.Places(counts, 16, 3)
    windows = {}
    for n, c in counts.items():
        for k in range(c):
            parts = places.of(n, k)
            assert [p[0] for p in parts] == list(np.cumsum([0] + [p[1] for p in parts])[:-1]) and sum(p[1] for p in parts) == n
            for _, size, window, offset in parts:
                windows.setdefault(window, []).append((offset, size))
    total = sum(n * c for n, c in counts.items())
    assert sorted(windows) == list(range(3, 3 + -(-total // 16)))
    for window, parts in windows.items():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [s for _, s in parts])[:-1])
    assert sum(sum(s for _, s in parts) < 16 for parts in windows.values()) <= 1


def check_pieces(pieces, texts, encode, capacity):
    """Every id of every document lies in one piece, and windows have no gaps and one at most is not full."""
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in windows.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [s for _, s in parts])[:-1])
    assert sum(sum(s for _, s in parts) < capacity for parts in windows.values()) <= 1
    assert sorted(windows) == list(range(len(windows)))
    expected, got = Counter(), Counter()
    by_key = {}
    for d, t in texts:
        ids = (*encode(t), 2)
        by_key.setdefault((d, len(ids)), []).append(ids)
        expected[d] += len(ids)
    for p in pieces:
        got[p["doc_id"]] += p["length"]
        found = [ids[p["start"] : p["start"] + p["length"]] for ids in by_key[p["doc_id"], p["doc_tokens"]]]
        assert p["crc"] in map(crc, found)
    assert got == expected


def test_packing(spark, docs, word):
    pieces = [r.asDict() | {"crc": r["ids_crc32"]} for r in queries.op4_window_packing(spark, SMALL).collect()]
    check_pieces(pieces, pairs(docs), word, 4096)


def test_odd_packing(odd, none, word):
    pieces = [r.asDict() | {"crc": zlib.crc32(r["ids"])} for r in packing.pack(odd, WORD, 2, 64).collect()]
    check_pieces(pieces, pairs(odd), word, 64)
    assert packing.pack(none, WORD, 2, 64).collect() == []


def test_files(spark, docs, word):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op7_token_files(spark, SMALL).collect()}
    start, expected = 0, {}
    for d, t in sorted(pairs(docs)):
        ids = [*word(t), 2]
        expected[d] = (start, len(ids), crc(ids))
        start += len(ids)
    assert got == expected


def test_odd_files(spark, odd, none, word, tmp_path):
    token_files.write_token_files(odd, f"{tmp_path}/a", WORD, 2)
    read = token_files.read_token_files(spark, f"{tmp_path}/a")
    expected = sorted(((d, [*word(t), 2]) for d, t in pairs(odd)), key=repr)
    assert sorted(((r["doc_id"], r["ids"]) for r in read.collect()), key=repr) == expected
    spans = sorted((r["start"], r["n_tokens"]) for r in token_files.describe(spark, f"{tmp_path}/a").collect())
    assert [s for s, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1])
    assert [r["ids"] for r in token_files.lookup(spark, f"{tmp_path}/a", [4, 77]).collect()] == [[*word("one"), 2]]
    plan = token_files.lookup(spark, f"{tmp_path}/a", [4, 77])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id, [4,77])]" in plan
    token_files.write_token_files(none, f"{tmp_path}/b", WORD, 2)
    assert token_files.describe(spark, f"{tmp_path}/b").collect() == []
