import hashlib
import random
import re
import zlib

import pytest
from corpus_rows import *  # noqa: F403  fixtures
from hypothesis import given, settings, strategies as st

from tidewater.llm.periodic_runs import kept_words, periodic_runs, runs_of
from tidewater.llm.queries import op12_periodic_runs


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i - q] for i in range(q, len(words))))


def plain_runs(words, min_words=12):
    """By definition: maximal stretches of each distance, of smallest period only."""
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(min_words, 2 * q) and smallest_period(words[i:i + length]) == q:
                out.add((i, length, q))
            i = j
    return sorted(out)


def plain_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=70), max_size=4), st.integers(1, 14))
def test_runs_of_two_words(texts, least):
    assert runs_of(texts, least) == [plain_runs(t, least) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=6), st.integers(1, 9)), max_size=8),
       st.integers(0, 3))
def test_runs_of_nested_repeats(parts, cut):
    words = [w for part, times in parts for w in part * times]
    words = words + words[cut:] + ["z"] + words[:len(words) // 2]
    (found,) = runs_of([words])
    assert found == plain_runs(words)
    assert kept_words(words, found) == plain_kept(words, found)


def test_long_uniform_text_and_many_contexts():
    draw = random.Random(3)
    phrase = "one two three four five six seven".split()
    mixed = [w for i in range(3_000) for w in [*phrase, f"x{draw.randrange(5_000)}", *["y"] * draw.randrange(4)]]
    found = runs_of([["a"] * 60_000, [], ["a"] * 11, ["a"] * 12, mixed])
    assert found[:4] == [[(0, 60_000, 1)], [], [], [(0, 12, 1)]]
    assert all(smallest_period(mixed[s:s + n]) == q for s, n, q in found[4])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(plain_kept(words, runs))))


def test_query_matches_definition(spark, scratch):
    draw = random.Random(11)
    rows = []
    for i in range(150):
        words = [draw.choice("ab cd ef gh ij".split()) for _ in range(draw.randrange(60))]
        rows.append((i, draw.choice([" ", "\n", " \t"]).join(words * draw.randrange(1, 3)) + draw.choice(["", " \x0b"])))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "é x " * 20), (203, "same id"), (204, "字 😀 " * 9)]
    folder = scratch("docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    out = op12_periodic_runs(spark, folder)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert {f.dataType.simpleString() for f in out.schema if not f.name.endswith("sha256")} == {"bigint"}
    assert sorted(map(tuple, out.collect()), key=str) == sorted((plain_row(*r) for r in rows), key=str)


def test_query_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()  # noqa: F405
    found = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, SF_SMALL).collect()}  # noqa: F405
    short = [r for r in docs if len((r.text or "").split()) < 1_200]
    assert len(found) == len(docs) and len(short) > 150
    assert [found[r.doc_id] for r in short] == [plain_row(r.doc_id, r.text) for r in short]


def test_odd_rows(odd_docs, odd_rows, no_docs):
    out = periodic_runs(odd_docs).collect()
    assert len(out) == len(odd_rows)
    assert {r.n for r in out if r.id in (3, 4, 5)} == {0}
    (long,) = {(r.n, tuple(map(tuple, r.runs)), r.collapsed) for r in out if r.id in (6, 7)}
    assert long[1][-1][2] == 14 * 700 and len(long[2].split()) < long[0] / 10
    assert periodic_runs(no_docs).collect() == [] and periodic_runs(no_docs).columns == ["id", "n", "runs", "collapsed"]


@pytest.mark.parametrize("words,runs", [("a b " * 6, [(0, 12, 2)]), ("a b " * 5 + "a", []), ("x " + "a " * 12, [(1, 12, 1)])])
def test_shortest_runs(words, runs):
    assert runs_of([words.split()]) == [runs]
