"""Toxicity by maximum-scoring segments over token log-odds.

1. Features of a word are the word and its first 4, 5 and 6 bytes (inflected
   words share a stem). From labelled documents, each feature gets the log-odds
   of appearing in a toxic document against a clean one, under a Dirichlet prior
   proportional to its overall frequency; features with a high score that a
   share of the toxic documents holds are kept. A word scores as its longest kept feature, any other word as a
   small negative number.
2. A linear scan finds all maximal scoring segments of a text.
3. Segment scores are calibrated as extreme values: a segment of score S in a
   text of n words has ``E = K n exp(-lambda S)`` chance equals, with lambda and
   K from the clean labelled documents. The evidence of a text is the sum of
   ``-ln E`` over its significant segments, and a logistic fit on labelled
   documents turns evidence into a probability.

Only words go into a score: no label, language, source or id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import column, fresh_names, id_text, raw_texts, schema_of, small_batches, stable_sample

#: Labelled documents a class that the model is fitted on, at most.
MAX_LABELLED = 10_000
MAX_FEATURES = 50_000
#: A feature must be in this many toxic documents, and in this share of them.
MIN_TOXIC_DOCS = 4
MIN_TOXIC_SHARE = 0.01
MIN_LOG_ODDS = 3.0
PRIOR_DOCS = 20.0
#: What a word without evidence costs a segment.
DRIFT = 0.15
SIGNIFICANT = 0.05
THRESHOLD = 0.3
STEMS = (6, 5, 4)
_CACHE_WORDS = 150_000
#: Features a task counts before it sends the counts on.
_HELD_FEATURES = 200_000
_LETTERS = bytes(b if b >= 128 else (b | 32 if chr(b).isalpha() else 32) for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII bytes, A-Z lower-cased."""
    return text.translate(_LETTERS).split()


def features(found: set[bytes]) -> set[bytes]:
    """The words, and their stems marked by a star."""
    out = set(found)
    for n in STEMS:
        out.update(w[:n] + b"*" for w in found if len(w) > n)
    return out


@dataclass
class ToxicityModel:
    weights: dict[bytes, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    slope: float = 0.0
    intercept: float = -20.0

    def word_score(self, word: bytes) -> float:
        """The log-odds of the word's longest kept feature, else 0."""
        score = self.weights.get(word)
        for n in STEMS:
            if score is None and len(word) > n:
                score = self.weights.get(word[:n] + b"*")
        return score or 0.0

    def segments(self, text: bytes, scores: dict | None = None) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of words, and all maximal segments (first, last word, score)."""
        found = words(text)
        get = (scores if scores is not None else _Scores(self)).__getitem__
        values = np.fromiter(map(get, found), np.float64, len(found))
        at = np.flatnonzero(values)
        return len(found), maximal_segments(at.tolist(), values[at].tolist())

    def evidence(self, n: int, segments) -> tuple[float, list[tuple[int, int, float]]]:
        """Summed ``-ln E`` of the significant segments, and these."""
        total, kept = 0.0, []
        for first, last, score in segments:
            log_e = math.log(self.scale * n) - self.rate * score
            if log_e < math.log(SIGNIFICANT):
                total -= log_e
                kept.append((first, last, score))
        return total, kept

    def probability(self, evidence: float) -> float:
        x = self.intercept + self.slope * math.log1p(evidence)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


class _Scores(dict):
    """Scores of the words met so far."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, word):
        if len(self) > _CACHE_WORDS:
            self.clear()
        score = self[word] = self.model.word_score(word)
        return score


def maximal_segments(at: list[int], values: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments; words between the positions cost ``DRIFT``.

    ``at`` are the positions of positive ``values``. A segment is held with the
    sums before and after it and the last segment before it with a smaller sum
    before; each one is looked at a bounded number of times on average.
    """
    held: list[tuple] = []  # (sum before, sum after, first, last, smaller)
    total, seen = 0.0, 0
    for position, value in zip(at, values):
        total -= DRIFT * (position - seen)
        before, first = total, position
        total += value
        seen = position + 1
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][0] >= before:
                j = held[j][4]
            if j < 0 or held[j][1] >= total:
                held.append((before, total, first, position, j))
                break
            before, first = held[j][0], held[j][2]
            del held[j:]
    return [(first, last, after - before) for before, after, first, last, _ in held]


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Fit on at most ``max_labelled`` labelled documents of each class.

    ``labels`` holds the rows that may be learned from; an id with several
    labels counts as toxic if any of them is 1; rows without an id or a label
    do not count, and equal texts count once. A class with more labels than
    are sampled weighs as much as all its labels. Without toxic documents no
    text is toxic.
    """
    known = (labels.select(column(labels, id_col).alias("id"), column(labels, label_col).alias("toxic"))
             .where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic")))
    labelled = {int(r.toxic): r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = stable_sample(known.where("toxic = 1"), F.col("id"), max_labelled, labelled.get(1, 0)).union(
        stable_sample(known.where("toxic = 0"), F.col("id"), max_labelled, labelled.get(0, 0)))
    # What a sampled row of each class stands for.
    weights = [max(1.0, labelled.get(c, 0) / max_labelled) for c in (0, 1)]
    # At most 2 x max_labelled rows are broadcast.
    texts = (id_text(docs, id_col, text_col).join(F.broadcast(sample), "id")
             .groupBy("text").agg(F.max("toxic").cast("int").alias("toxic")).persist())
    try:
        model = ToxicityModel(_weights(texts, weights))
        if model.weights:
            _calibrate(model, texts, weights)
        return model
    finally:
        texts.unpersist()


def _weights(texts: DataFrame, weights: list[float]) -> dict[bytes, float]:
    def counted(batches):
        for b in batches:
            counts: tuple[dict, dict] = ({}, {})
            for text, toxic in zip(raw_texts(b.column(0)), b.column(1).to_pylist()):
                of = counts[toxic]
                for f in features(set(words(text))):
                    of[f] = of.get(f, 0) + 1
                if len(of) > _HELD_FEATURES:
                    yield summed(of, toxic)
                    of.clear()
            for toxic in (0, 1):
                yield summed(counts[toxic], toxic)

    def summed(counts, toxic):
        return pa.RecordBatch.from_arrays([
            pa.array(list(counts), pa.binary()), pa.array(np.full(len(counts), toxic, np.int32)),
            pa.array(list(counts.values()), pa.int64())], ["feature", "toxic", "n"])

    n = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return {}
    counts = texts.mapInArrow(counted, "feature binary, toxic int, n bigint").groupBy("feature").agg(
        F.sum(F.col("n") * F.col("toxic")).alias("t"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("c"))
    prior = (PRIOR_DOCS * (weights[1] * F.col("t") + weights[0] * F.col("c"))
             / (weights[1] * toxic + weights[0] * clean))
    odds = (F.log((F.col("t") + prior) / (toxic + PRIOR_DOCS - F.col("t") - prior + 1))
            - F.log((F.col("c") + prior) / (clean + PRIOR_DOCS - F.col("c") - prior + 1)))
    least = max(MIN_TOXIC_DOCS, MIN_TOXIC_SHARE * toxic)
    kept = (counts.where(F.col("t") >= least).select("feature", "t", odds.alias("odds"))
            .where(F.col("odds") >= MIN_LOG_ODDS).orderBy(F.desc("t"), "feature").limit(MAX_FEATURES))
    return {bytes(r.feature): r.odds for r in kept.collect()}


def _calibrate(model: ToxicityModel, texts: DataFrame, weights: list[float]) -> None:
    """Set lambda and K from the clean texts, then the logistic fit."""

    def scanned(batches):
        scores = _Scores(model)
        for b in small_batches(batches):
            rows = [model.segments(t, scores) for t in raw_texts(b.column(0))]
            hits = [sorted((s for _, _, s in found), reverse=True) for _, found in rows]
            singles = [[round(scores[w], 1) for w in words(t) if scores[w]] for t in raw_texts(b.column(0))]
            yield pa.RecordBatch.from_arrays([
                b.column(1), pa.array([n for n, _ in rows], pa.int64()),
                pa.array(hits, pa.list_(pa.float64())), pa.array(singles, pa.list_(pa.float64())),
            ], ["toxic", "n", "segments", "singles"])

    # At most 2 x max_labelled rows; a row has numbers for its positive words only.
    rows = texts.mapInArrow(scanned, "toxic int, n bigint, segments array<double>, singles array<double>").persist()
    try:
        clean = rows.where("toxic = 0")
        n_words = clean.agg(F.sum("n")).first()[0] or 1
        single = clean.select(F.explode("singles").alias("s")).groupBy("s").count().collect()
        model.rate = _rate({r.s: r["count"] / n_words for r in single})
        cuts = clean.select(F.explode("segments").alias("s")).where(f"s >= {MIN_LOG_ODDS}")
        model.scale = max(1, cuts.count()) * math.exp(model.rate * MIN_LOG_ODDS) / n_words
        seen = rows.select("toxic", "n", "segments").collect()
    finally:
        rows.unpersist()
    evidence = np.array([model.evidence(max(1, r.n), [(0, 0, s) for s in r.segments])[0] for r in seen])
    toxic = np.array([r.toxic for r in seen], dtype=float)
    model.slope, model.intercept = _logistic(np.log1p(evidence), toxic, np.where(toxic == 1, weights[1], weights[0]))


def _rate(shares: dict[float, float]) -> float:
    """The positive root of ``sum p exp(lambda s) = 1`` for the clean words."""
    values, p = np.array(list(shares) or [1.0]), np.array(list(shares.values()) or [1e-9])
    rest = max(0.0, 1 - p.sum())
    low, high = 0.0, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        if (p * np.exp(np.minimum(700, mid * values))).sum() + rest * math.exp(-mid * DRIFT) < 1:
            low = mid
        else:
            high = mid
    return max(low, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a lightly penalised, weighted logistic fit (Newton)."""
    design, beta = np.column_stack([x, np.ones_like(x)]), np.zeros(2)
    penalty = np.diag([1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = design.T @ (design * (weight * p * (1 - p))[:, None]) + penalty
        step = np.linalg.solve(hessian, design.T @ (weight * (y - p)) - penalty @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns of ``docs``, ``score``, ``predicted`` and ``passages``
    (new names if a kept column has one of these).

    A null or empty text has no evidence and gets the score of such texts.
    ``passages`` are the significant segments as first and last word numbers
    (words are runs of letters) and their score.
    """
    rows = docs.select(*[column(docs, c) for c in keep],
                       F.coalesce(column(docs, text_col).cast("string"), F.lit("")))
    rows = rows.toDF(*keep, *fresh_names(docs.select(*[column(docs, c) for c in keep]), "whole_text"))
    schema = rows.select(*[column(rows, c) for c in keep]).schema
    names = fresh_names(rows, "score", "predicted", "passages")
    for name, kind in zip(names, ("double", "int", "array<struct<first:int,last:int,score:double>>")):
        schema = schema.add(schema_of(**{name: kind})[0])

    def scored(batches):
        scores = _Scores(model)
        for b in small_batches(batches):
            p, spans = [], []
            for text in raw_texts(b.column(b.num_columns - 1)):
                n, found = model.segments(text, scores)
                evidence, kept = model.evidence(max(1, n), found)
                p.append(model.probability(evidence))
                spans.append([{"first": a, "last": z, "score": s} for a, z, s in kept])
            p = np.array(p)
            yield pa.RecordBatch.from_arrays([
                *b.columns[:-1], pa.array(p), pa.array((p >= threshold).astype(np.int32)),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))),
            ], schema.fieldNames())

    return rows.mapInArrow(scored, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with their columns."""
    scored = score_toxicity(docs, model, text_col, threshold, tuple(docs.columns))
    predicted = scored.columns[len(docs.columns) + 1]
    return scored.where(F.col(predicted) == 0).select(*[column(scored, c) for c in docs.columns])


def held_out(id_col: Column) -> Column:
    """True for the quarter of ids that is never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))
