import math

import pytest
from corpus_rows import *  # noqa: F403  fixtures
from hypothesis import given, settings, strategies as st

from tidewater.llm.queries import op8_token_counts
from tidewater.llm.token_counts import PrefixTrie, UnigramVocabulary, public_path, token_counts


@pytest.fixture(scope="session")
def vocabulary():
    return UnigramVocabulary(public_path("piece_bpe_32k.model"))


def best_path(vocabulary, word):
    """Score and tokens of the best path, over all cuts of the word."""
    word = "▁" + word
    best = [(0.0, 0)]
    for j in range(1, len(word) + 1):
        ways = []
        for i in range(j):
            s = vocabulary.scores.get(word[i:j])
            if s is not None:
                ways.append((best[i][0] + s, -(best[i][1] + 1)))
        size = len(word[j - 1].encode())
        ways.append((best[j - 1][0] + size * vocabulary.byte_score, -(best[j - 1][1] + size)))
        top = max(ways)
        best.append((top[0], -top[1]))
    return best[-1]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text(alphabet="abethionr字😀é.", min_size=1, max_size=12), max_size=30))
def test_trie_matches_all_cuts(vocabulary, words):
    trie = PrefixTrie(vocabulary)
    trie.insert(words)
    for w in words:
        score, n = best_path(vocabulary, w)
        assert trie.counts[w][1] == pytest.approx(score, abs=1e-9)
        assert trie.counts[w][0] == n
    assert trie.nodes <= sum(len(w) + 1 for w in words)


def test_prefixes_are_shared(vocabulary):
    trie = PrefixTrie(vocabulary)
    trie.insert({"token", "tokens", "tokenise", "tokeniser"})
    assert trie.nodes == len("▁tokeniser") + len("s")


def test_query_matches_all_cuts(spark, vocabulary):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op8_token_counts(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    paths = {}
    for r in got:
        words = docs[r.doc_id].split()
        for w in words:
            if w not in paths:
                paths[w] = best_path(vocabulary, w)
        assert (r.n_words, r.n_tokens) == (len(words), sum(paths[w][1] for w in words))
        assert r.log_score == pytest.approx(math.fsum(paths[w][0] for w in words), rel=1e-9, abs=1e-9)


def test_odd_rows(odd_docs, odd_rows, no_docs, monkeypatch):
    got = token_counts(odd_docs).collect()
    assert sorted(str((r.id, r.n_words)) for r in got) == sorted(str((i, len((t or "").split()))) for i, t in odd_rows)
    assert all((r.n_tokens, r.log_score) == (0, 0.0) for r in got if r.n_words == 0)
    assert all(r.n_tokens >= r.n_words for r in got)
    assert token_counts(no_docs).collect() == []


def test_a_shared_prefix_is_scored_once(vocabulary, monkeypatch):
    words = [f"{a}{b}{c}" for a in ("the", "then", "tha") for b in ("", "re", "rem") for c in ("", "s", "字")]
    prefixes = {("▁" + w)[:n] for w in words for n in range(1, len(w) + 2)}
    once, apart, again = (PrefixTrie(vocabulary) for _ in range(3))
    once.insert(set(words))
    for w in words:
        apart.insert({w})
    assert once.nodes == apart.nodes == len(prefixes)
    monkeypatch.setattr("tidewater.llm.token_counts.MAX_NODES", 5)  # starts anew again and again
    for w in words:
        again.insert({w})
    assert again.nodes > len(prefixes) and once.counts == apart.counts == again.counts
