import os
import zlib

import numpy as np
import pytest
from corpus_rows import *  # noqa: F403  fixtures
from hypothesis import given, settings, strategies as st

from tidewater.llm import packing
from tidewater.llm.queries import op7_best_fit_packing
from tidewater.llm.tokens import CachedTokenizer, public_path


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    return lambda text: lib.encode(text, add_special_tokens=False).ids


def check_packed(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return by_sequence


def expected_pieces(ids, capacity):
    first = (len(ids) - 1) % capacity + 1
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))
            for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def test_query_matches_library(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    got = op7_best_fit_packing(spark, SF_CHECK).collect()
    want = {(i, *p) for i, t in docs for p in expected_pieces([*library(t or ""), 0], 2048)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    least = -(-sum(r.length for r in got) // 2048)
    assert len(check_packed(got, 2048)) <= 1.01 * least + 1


def test_odd_rows(odd_docs, odd_rows, no_docs, library):
    got = packing.pack(packing.token_pieces(odd_docs, capacity=64), capacity=64, open_bins=3, task_pieces=500).collect()
    check_packed(got, 64)
    want = sorted(str((i, *p)) for i, t in odd_rows for p in expected_pieces([*library(t or ""), 0], 64))
    assert sorted(str((r.id, r.piece, r.start, r.length, r.ids_crc32)) for r in got) == want
    assert packing.pack(packing.token_pieces(no_docs)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 10))
def test_best_fit_rules(lengths, open_bins):
    """A plain list of open bins takes the same decisions on free space."""
    bins, offsets = packing.best_fit(lengths, 50, open_bins)
    free, n_bins = [], 0
    for i, size in enumerate(lengths):
        fits = [f for f in free if f >= size]
        if fits:
            free.remove(min(fits))
            assert offsets[i] == 50 - min(fits)
            left = min(fits) - size
        else:
            n_bins += 1
            assert offsets[i] == 0
            left = 50 - size
        if left:
            free.append(left)
        if len(free) > open_bins:
            free.remove(min(free))
    assert len(set(bins.tolist())) == n_bins


def test_few_sequences_beyond_the_open_bins(spark):
    """Far more pieces over half a sequence in one task than bins stay open."""
    rng = np.random.default_rng(7)
    lengths = np.concatenate([rng.integers(1025, 2048, 9000), rng.integers(20, 900, 21000)]).tolist()
    rows = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)],
                                 "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    got = packing.pack(rows).collect()
    assert sorted(r.length for r in got) == sorted(lengths)
    least = -(-sum(lengths) // 2048)
    assert len(check_packed(got, 2048)) <= 1.005 * least


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab Zé.\n\t ,'s!\x1c\x85\xa0²½ñ字<|>\r\x0b_-0 9😀ßµªºlld", max_size=40))
def test_cached_ids_are_the_librarys(library, text):
    cached = CachedTokenizer(public_path("byte_bpe_50k.json"), chunks=3, words=3)
    for t in (text, f"{text} {text}", "<|endoftext|>" + text):
        assert np.frombuffer(cached.encode([t])[0], dtype="<u4").tolist() == library(t)


def test_a_chunk_is_encoded_once_for_many_texts(library, monkeypatch):
    """However few words and chunks the caches hold."""
    cached = CachedTokenizer(public_path("byte_bpe_50k.json"), chunks=1, words=1)
    calls, split, words = [], cached._split, cached._words
    cached._split = lambda text: calls.append(text) or split(text)
    tokenize = words._tokenize
    words._tokenize = lambda word: calls.append(word) or tokenize(word)
    texts = ["one two, three.\nFour\n\nfive é42 x-y"] * 100
    got = cached.encode(texts)
    assert np.frombuffer(got[0], "<u4").tolist() == library(texts[0]) and len(set(got)) == 1
    assert len(calls) < 200  # 100 for the texts' first chunks


def test_caches_leave_a_worker_room():
    """What stays in a worker after a stage, in entries; the pipeline's later stages share it."""
    from tidewater.llm import toxicity

    cached = CachedTokenizer(public_path("byte_bpe_50k.json"))
    assert cached._chunks._most + 2 * cached._words._most <= 650_000 and toxicity._CACHE_WORDS <= 150_000
    cached = CachedTokenizer(public_path("byte_bpe_50k.json"), chunks=5, words=7)
    for n in range(40):
        cached.encode([f"word{n} other {n}-{n} wör{n}", "abc" * n])
        assert len(cached._words) <= 7 and len(cached._words._before) <= 7 and len(cached._chunks) <= 5
