import hashlib
import random
import re
from collections import Counter

import xxhash
from corpus_rows import *  # noqa: F403  fixtures
from hypothesis import given, settings, strategies as st

from tidewater.llm import substring_dedup
from tidewater.llm.queries import op6_substring_dedup
from tidewater.llm.substring_dedup import MIN_WORDS, REACH, UNIT_WORDS, cut_runs, normal, remove_repeats, units


def plain_units(text):
    """Character spans and words of the units, character by character."""
    sentences, start = [], 0
    for k in range(1, len(text) + 1):
        ends = text[k - 1] in ".!?" and k < len(text) and text[k] in " \t\r\x0b\x0c"
        if text[k - 1] == "\n" or ends or k == len(text):
            sentences.append((start, k))
            start = k
    out, start, held = [], 0, []
    for a, b in sentences:
        words = [(m.start() + a, m[0]) for m in re.finditer(r"[A-Za-z0-9\u0080-\U0010ffff]+", text[a:b])]
        words = [(at, re.sub("[A-Z]", lambda m: m[0].lower(), w)) for at, w in words]
        ranks = [xxhash.xxh3_64_intdigest(w.encode()) for _, w in words]
        last = -REACH
        for i, (at, w) in enumerate(words):
            inner = REACH <= i < len(words) - REACH and i - last >= REACH
            if inner and ranks[i] == min(ranks[i - REACH:i + REACH + 1]):
                out.append((start, at, held))
                start, held, last = at, [], i
            held = [*held, w]
        if len(held) >= UNIT_WORDS or text[b - 1] == "\n" or b == len(text):
            out.append((start, b, held))
            start, held = b, []
    return out


def brute(rows, min_words):
    """Kept text and removed runs per (id, text) from the rules alone: the earliest
    unit of each word sequence stays, later ones go in runs of enough words."""
    ranked = sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    cut, first = {row: plain_units(row[1]) for row in ranked}, {}
    for row in ranked:
        for k, (_, _, words) in enumerate(cut[row]):
            if words:
                first.setdefault(tuple(words), (row, k))
    out = {}
    for row in ranked:
        runs, now = [], None
        for k, (a, b, words) in enumerate(cut[row]):
            if words and first[tuple(words)] != (row, k):
                if now is None:
                    now = {"start": a, "first_id": first[tuple(words)][0][0], "n": 0}
                    runs.append(now)
                now |= {"end": b, "n": now["n"] + len(words)}
            elif words:
                now = None
        runs = [r for r in runs if r["n"] >= min_words]
        text, at, kept = row[1], 0, ""
        for r in runs:
            kept, at = kept + text[at:r["start"]], r["end"]
        out[row] = (kept + text[at:]).encode(), [{x: r[x] for x in ("start", "end", "first_id")} for r in runs]
    return out


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    want = brute(docs, MIN_WORDS)
    got = op6_substring_dedup(spark, SF_CHECK).collect()
    assert len(got) == len(docs)
    kept = {i: (hashlib.sha256(text).hexdigest(), runs) for (i, _), (text, runs) in want.items()}
    for r in got:
        assert (r.kept_sha256, [x.asDict() for x in r.removed]) == kept[r.doc_id]
    assert sum(r.n_removed for r in got) > 50


def test_shouted_words_are_no_repeats(spark):
    rows = [(k, " ".join(f"{w}!!" for w in order.split())) for k, order in enumerate([
        "SO MANY SINGLE WORDS THAT ALL STAND ALONE IN EVERY TEXT BUT NEVER THE SAME WAY ROUND",
        "ROUND WAY SAME THE NEVER BUT TEXT EVERY IN ALONE STAND ALL THAT WORDS SINGLE MANY SO"])]
    out = remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), min_words=8).collect()
    assert {r.doc_id: r.text for r in out} == dict(rows)


def test_passages_anywhere_in_a_line(spark):
    passage = " ".join(f"Sentence {k} of the passage holds a few words." for k in range(9))
    rows = [(1, f"Alpha beta gamma delta. {passage} The end."), (2, f"Other start here. {passage} Another end.\nMore."),
            (3, "The end. Another end.\nMore."), (4, passage + "\n" + passage)]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].text == rows[0][1] and got[3].text == rows[2][1]
    # The passage goes, with the repeated sentence after it that is part of the same run.
    assert passage not in got[2].text and got[2].text.startswith("Other start here.")
    assert got[4].text.strip() == ""
    assert [x.first_id for x in got[2].removed] == [1]
    for r in got.values():
        text, at, left = dict(rows)[r.doc_id], 0, ""
        for x in r.removed:
            left, at = left + text[at:x.start], x.end
        assert left + text[at:] == r.text


def test_passages_inside_longer_sentences(spark):
    """No sentence of the texts repeats, only 50 words within them do."""
    rng = random.Random(5)

    def some(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))

    rows = []
    for k in range(40):
        passage = some(50)
        rows += [(2 * k, f"{some(9)} {passage} {some(12)}."), (2 * k + 1, f"{some(23)} {passage.upper()}, {some(5)}")]
    rows += [(100, some(400)), (101, some(400))]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    cut = {r.doc_id: [x.first_id for x in r.removed] for r in got}
    assert sum(bool(v) for k, v in cut.items() if k < 80) >= 38
    assert all(v == ([k - 1] if k % 2 and k < 80 and v else []) for k, v in cut.items())
    for r in got:
        assert all(len(dict(rows)[r.doc_id][x.start:x.end].split()) <= 50 for x in r.removed)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    out = remove_repeats(odd_docs, min_words=2)
    assert out.columns == [*odd_docs.columns, "removed_"]
    got = out.collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r.text for r in got if r.doc_id not in (2, None)}
    # Row 1 keeps its first lines but the repeat within it; 7 copies 6; 10 copies 9, but is one word.
    assert by_id[3] == by_id[4] == "" and by_id[7] == "" and by_id[10] == "word"
    assert len(by_id[6]) < len(dict(odd_rows)[6])
    none = Counter(r.text for r in got if r.doc_id is None)
    assert none == Counter({"no id\nsame line": 2, "": 1})
    assert remove_repeats(no_docs).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n\tÉ", max_size=60))
def test_units_cover_the_text(text):
    data = text.encode()
    spans = units(data)
    assert b"".join(data[a:b] for a, b, _ in spans) == data
    assert all(b"\n" not in data[a:b - 1] and words == normal(data[a:b]) for a, b, words in spans)
    assert cut_runs(data, dict.fromkeys(range(len(spans)), 1), 10**6) == (data, [])
    assert substring_dedup.normal(data) == substring_dedup.normal(data.upper().replace(b"\xc3\x89", b"\xc3\x89").lower())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc .!?\n\tÉé-", max_size=120))
def test_units_match_the_rules(text):
    data = text.encode()
    got = [(len(data[:a].decode()), len(data[:b].decode()), [w.decode() for w in words]) for a, b, words in units(data)]
    assert got == plain_units(text)
