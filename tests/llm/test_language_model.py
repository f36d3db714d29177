import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus_rows import *  # noqa: F403  fixtures
from pyspark.sql import functions as F

from tidewater.llm import language_model as lm
from tidewater.llm.common import id_text
from tidewater.llm.queries import op11_language_model

END = "\n"


def tokens_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


def plain_base(rows):
    """Every column but the model's score, by definition."""
    held = [zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in rows]
    counts = Counter(t for (_, text), h in zip(rows, held) if not h for t in tokens_of(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for (i, text), h in zip(rows, held):
        tokens = tokens_of(text)
        base = math.fsum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        out.append((i, h, len(tokens), sum(counts[t] > 0 for t in tokens), total, base))
    return out


@pytest.fixture(scope="session")
def letters_docs():
    """Texts whose next word mostly follows from the word before."""
    draw = random.Random(2)
    rows = []
    for i in range(400):
        words = [draw.choice("abcdefgh")]
        for _ in range(draw.randrange(120)):
            step = 1 if draw.random() < 0.9 else draw.randrange(8)
            words.append("abcdefgh"[(("abcdefgh".index(words[-1][0])) + step) % 8])
        rows.append((i, " ".join(w * draw.choice([1, 1, 1, 2]) for w in words)))
    return rows


def test_base_columns_match_definition(spark, scratch):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice(["The", "the", "a", "é", "É", f"w{draw.randrange(300)}"]) for _ in range(draw.randrange(50))))
            for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n"), (3, "same id the"), (None, "no id the"), (203, "the " * 5_000)]
    folder = scratch("docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    out = op11_language_model(spark, folder)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in out.schema] == [
        "doc_id bigint", "held_out boolean", "n_tokens bigint", "n_known bigint", "train_tokens bigint",
        "base_score double", "score double"]
    got = sorted((tuple(r) for r in out.collect()), key=lambda r: str(r[:6]))
    want = sorted(plain_base(rows), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    assert all(r[6] <= 0 and math.isfinite(r[6]) for r in got)


def fitted(spark, rows, learn):
    texts = id_text(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text")
    counts = lm.word_counts(texts.where(learn))
    vocabulary = lm.Vocabulary.of(counts)
    encoded = lm.encode(texts, learn, vocabulary)
    return counts, vocabulary, encoded, lm.train(encoded, vocabulary)


def test_scores_are_products_of_normalised_probabilities(spark, letters_docs, monkeypatch):
    monkeypatch.setattr(lm, "COMMON_SHARE", 1e-2)  # so that some words come by the join
    rows = letters_docs + [(400, "unseen words here"), (401, None)]
    learn = F.col("id") % 5 != 0
    counts, vocabulary, encoded, model = fitted(spark, rows, learn)
    n = {bytes(r.word).decode(): r.n for r in counts.collect()}
    assert n == Counter(t for i, text in rows if i % 5 for t in tokens_of(text))
    head = {w.decode(): i for i, w in enumerate(vocabulary.head)}

    def class_of(word):
        return head.get(word, lm.HEAD_WORDS + lm.tail_class(word.encode()))

    per_class = Counter()
    for w, c in n.items():
        per_class[class_of(w)] += c
    assert [per_class[k] for k in range(len(vocabulary.class_tokens))] == vocabulary.class_tokens.tolist()
    # In each class with words: known words and the unseen one add up to one.
    for k in per_class:
        words = [w for w in n if class_of(w) == k]
        rest = 0 if k < lm.HEAD_WORDS else 10 ** vocabulary.inside(k, 0)
        assert math.fsum(10 ** vocabulary.inside(k, n[w]) for w in words) + rest == pytest.approx(1)

    def plain(text):
        total, before = 0.0, [END] * lm.CONTEXT
        for t in tokens_of(text):
            h = sum(model.inputs[class_of(w)] @ c for w, c in zip(before, model.places))
            s = (model.outputs @ h + model.bias).astype(float)
            p = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
            total += math.log10(p[class_of(t)]) + vocabulary.inside(class_of(t), n.get(t, 0))
            before = [t, *before[:-1]]
        return total

    got = {r.id: r.score for r in lm.score(encoded, counts, vocabulary, model).collect()}
    want = {i: plain(text) for i, text in rows[::7] + rows[-2:]}
    assert {i: got[i] for i in want} == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_training_learns_what_follows(spark, letters_docs):
    out = lm.language_model_scores(
        spark.createDataFrame(letters_docs, "doc_id bigint, text string").coalesce(1), F.col("id") % 5 != 0, passes=10)
    held = out.where("not learn").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held[0] / held[2] > held[1] / held[2] + 0.25


def test_held_out_documents(spark):
    held = op11_language_model(spark, SF_CHECK).where("held_out").agg(  # noqa: F405
        F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held[0] / held[2] > held[1] / held[2] + 0.4


def test_noise_contrastive_estimate_meets_the_data():
    noise = np.array([0.4, 0.3, 0.2, 0.1])
    draw = np.random.default_rng(1)
    texts = [draw.choice(4, 3000, p=[0.1, 0.2, 0.3, 0.4]).astype(np.uint16)]
    model = lm.LogBilinear(noise)
    for _ in range(200):
        model.train(texts, draw)
    before, token = model.contexts(texts)
    scores = sum(model.inputs[before[:, i]] @ c for i, c in enumerate(model.places)) @ model.outputs.T + model.bias
    share = (np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)).mean(axis=0)  # not that of the noise
    assert share == pytest.approx(np.bincount(token) / len(token), abs=0.02)


def test_same_classes_in_spark(spark):
    words = [b"a", b"ab", b"abc", "é".encode(), "x字".encode(), b"\n", b"\x00"]
    rows = spark.createDataFrame([(bytearray(w),) for w in words], "word binary").select("word", lm._tail_class("word")).collect()
    assert [r[1] for r in rows] == [lm.tail_class(w) for w in words]


def test_odd_rows(odd_docs, odd_rows, no_docs):
    learn = F.col("id") != 9
    out = lm.language_model_scores(odd_docs, learn).collect()
    assert len(out) == len(odd_rows) and {r.train_tokens for r in out} == {
        sum(len(tokens_of(t)) for i, t in odd_rows if i is not None and i != 9)}
    assert lm.language_model_scores(no_docs, learn).collect() == []
    untaught = lm.language_model_scores(odd_docs, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in untaught} == {(0, 0, 0.0)}
    assert all(math.isfinite(r.score) for r in untaught)
