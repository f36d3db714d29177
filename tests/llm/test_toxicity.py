import math

import numpy as np
from corpus_rows import *  # noqa: F403  fixtures
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewater.llm import toxicity
from tidewater.llm.queries import op10_toxicity
from tidewater.llm.toxicity import DRIFT, ToxicityModel, maximal_segments


def by_definition(scores):
    """Maximal segments: the best one, then those to its left and right."""
    def find(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-9 and (best is None or total > best[0] + 1e-9):
                    best = (total, i, j)
        if best is None:
            return []
        return [*find(a, best[1]), (best[1], best[2], best[0]), *find(best[2] + 1, b)]

    return find(0, len(scores))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0.0, 0.0, 0.0, 0.37, 1.13, 2.71]), max_size=40))
def test_segments_match_definition(values):
    at = [k for k, v in enumerate(values) if v]
    got = maximal_segments(at, [values[k] for k in at])
    want = by_definition([v or -DRIFT for v in values])
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op10_toxicity(spark, folder).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    toxic = [r for r in rows if r.toxic == 1]
    assert right > 0.97 and sum(r.predicted for r in toxic) / len(toxic) > 0.9
    assert all(0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.3) for r in rows)


def test_query_columns_and_split(spark):
    got = op10_toxicity(spark, SF_SMALL).collect()
    import zlib

    assert len(got) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_odd_rows(spark, odd_docs, no_docs):
    model = ToxicityModel({b"vile": 6.0, b"curs*": 5.0}, rate=1.0, scale=0.01, slope=4.0, intercept=-4.0)
    assert model.word_score(b"cursed") == 5.0 and model.word_score(b"curs") == 0.0 and model.word_score(b"x") == 0.0
    docs = odd_docs.withColumn("text", F.when(F.col("doc_id") == 9, "so VILE, vile and cursing!").otherwise(F.col("text")))
    out = toxicity.score_toxicity(docs, model, keep=tuple(docs.columns))
    assert out.columns[-3:] == ["score_", "predicted_", "passages_"]
    rows = out.collect()
    assert len(rows) == docs.count()
    assert {r.doc_id for r in rows if r["predicted_"]} == {9}
    assert [(p.first, p.last) for r in rows if r.doc_id == 9 for p in r["passages_"]] == [(1, 4)]
    quiet = 1 / (1 + math.exp(4.0))
    assert {round(r["score_"], 9) for r in rows if r.doc_id in (3, 4, 5)} == {round(quiet, 9)}
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1
    assert toxicity.score_toxicity(no_docs, model, keep=("doc_id",)).collect() == []


def test_no_labels_or_one_class(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(1, 0), (2, 0), (None, 1), (4, None), (5, 7)], "doc_id bigint, toxic int")
    for labels in (none, one):
        model = toxicity.fit_toxicity(odd_docs, labels)
        assert {r.predicted for r in toxicity.score_toxicity(odd_docs, model, keep=("doc_id",)).collect()} == {0}


def test_sampled_classes_keep_their_share(spark):
    """The fit on a tenth of the clean labels decides like the fit on all of them."""
    rng = np.random.default_rng(3)
    neutral = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("an", "el", "ino", "ora", "ud")]
    rows = []
    for k in range(3300):
        text, toxic = rng.choice(neutral, 30).tolist(), int(k % 11 == 0)
        if toxic or k % 11 == 1 and k % 3 == 0:  # some clean texts hold the same word
            text.insert(5, "vilest")
        rows.append((k, " ".join(text), toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    models = [toxicity.fit_toxicity(docs, labels, max_labelled=n) for n in (10_000, 300)]
    assert abs(models[0].intercept - models[1].intercept) < 1.0
    assert abs(models[0].weights[b"vilest"] - models[1].weights[b"vilest"]) < 0.5
    held = spark.createDataFrame([(" ".join(rng.choice(neutral, 30)) + " vilest",)], "text string")
    scores = [toxicity.score_toxicity(held, m).first().score for m in models]
    assert abs(scores[0] - scores[1]) < 0.08
