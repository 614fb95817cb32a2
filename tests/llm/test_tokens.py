"""Operators 2 and 7: the tokenizers library, exact round trips, brute-force rank and select."""

from __future__ import annotations

import hashlib
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stationlake.llm import bpe_automaton, queries, wavelet

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  \n\n  two  blanks \t", "a" * 5000, "don't I'LL <|endoftext|> x<|startoftext|>", "AΣ İ ﬁ é",
       "x\x85y z \x1c w", "\U0001f600 　 1½٣", "same", "same", "café's   end "]


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_level():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def automaton():
    return bpe_automaton.WordTokenizer(bpe_automaton.default_path())


def expected_shards(docs, tok):
    start, out = 0, []
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_binary_output_on_all_documents(spark, byte_level):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.op2_token_ids(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=repr) == expected_shards(docs, byte_level)


def test_binary_output_edge_cases(spark, make_docs, byte_level):
    rows = [*enumerate(ODD), (3, "again"), (None, "no id"), (-7, "first"), (2**40, "last")]
    docs = make_docs(rows, "start, path")
    got = [tuple(r) for r in wavelet.binary_output(docs, shard_tokens=50).collect()]
    assert sorted(got, key=repr) == expected_shards(rows, byte_level)
    assert wavelet.binary_output(make_docs([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50256) | st.integers(0, 3) | st.sampled_from([2 ** 31, 2 ** 32 - 1]), max_size=300), st.sampled_from([8, 64, 1 << 15]))
def test_wavelet_matrix_is_the_sequence(ids, block):
    a = np.array(ids, np.uint32)
    w = wavelet.WaveletFile(wavelet.build(a, [1, None], [len(ids), 0], block))
    assert w.all_ids().tolist() == ids and w.doc_ids == [1, None]
    assert [w.access(i) for i in range(len(ids))] == ids
    for t in {*ids[:20], 0, 2, 70000}:
        at = [i for i, x in enumerate(ids) if x == t]
        assert w.count(t) == len(at) and list(w.occurrences(t)) == at
        lo, hi = len(ids) // 3, 2 * len(ids) // 3
        assert w.count(t, lo, hi) == ids[lo:hi].count(t)
        with pytest.raises(IndexError):
            w.select(t, len(at))


def test_wavelet_blocks_are_read_one_by_one():
    ids = np.random.default_rng(1).integers(0, 50257, 100_000).astype(np.uint32)
    w = wavelet.WaveletFile(wavelet.build(ids, [5], [len(ids)], 1024))
    assert w.access(77_777) == ids[77_777]
    assert w._bits.cache_info().misses <= 2 * w.planes


def digest(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_automaton_on_all_documents(spark, word_level):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op7_bpe(spark, SF).collect()}
    assert got == {d: digest(word_level, t) for d, t in docs}


def test_automaton_edge_cases(spark, make_docs, word_level):
    docs = make_docs(ODD, "n_tokens, ids_sha256")
    got = {r.doc_id: tuple(r)[1:] for r in bpe_automaton.encode_documents(docs).collect()}
    assert got == {i: digest(word_level, t) for i, t in enumerate(ODD)}
    assert bpe_automaton.encode_documents(docs.limit(0)).count() == 0


@settings(max_examples=500, deadline=None)
@given(text=st.text(alphabet="abcdehinorstANT'é́ßΣς1²½ \n\x85\x1c\U0001f600<|endoftext|>!?.", max_size=60))
def test_automaton_property(automaton, word_level, text):
    ids = word_level.encode(text, add_special_tokens=False).ids
    assert automaton.encode(text) == ids
    assert automaton.encode_chunk(text) == ids
    assert automaton.decode(ids) == word_level.decode(ids, skip_special_tokens=False)


def test_automaton_starts_anew_beyond_its_bound(monkeypatch, word_level):
    monkeypatch.setattr(bpe_automaton, "MAX_STATES", 5)
    tok = bpe_automaton.WordTokenizer(bpe_automaton.default_path())
    for t in ("international understanding", "thereandthere reading", "the the the"):
        assert tok.encode(t) == word_level.encode(t, add_special_tokens=False).ids


def test_gadgets_by_hand():
    """Symbols a b (0 1) and with the end of word (2 3); merges ab, aab, b+b-end."""
    m = bpe_automaton.Automaton({0: (97, False), 1: (98, False), 2: (97, True), 3: (98, True)},
                                [(0, 1, 4), (0, 4, 5), (1, 3, 6)])
    assert not m.arc(0, 1) and not m.arc(0, 4) and m.arc(0, 0) and m.arc(4, 0)
    assert m.encode(b"aab") == [0, 0, 3] and m.encode(b"aaba") == [0, 5, 2][1:] and m.encode(b"abb") == [4, 3]
    assert m.encode(b"bb") == [6] and m.encode(b"aabbb") == [5, 6]
    with pytest.raises(ValueError):
        bpe_automaton.Automaton({0: (97, False)}, [(0, 9, 4)])
