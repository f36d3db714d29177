"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Tokens are words and one end per text. A token's probability is that of its class
after the classes before it, times that of the word in its class:

* The most frequent words are classes of their own; every other word's class
  follows from its last two bytes. Each class has an input and an output vector.
  The context vector is the sum of the input vectors of the classes before, each
  through the matrix of its position; its products with all output vectors, plus
  biases, give the class probabilities by a softmax over all classes.
* In its class a word has its count in the training texts, less a discount; what
  the discounts leave is the share of one unseen word a class. So the
  probabilities of all known words and of an unseen one add up to one.

Counts cover every training text. Training passes over every training token: each
round takes its share of the documents, every task trains on its own rows from the
same start, and the results are averaged by tokens. The noise words of a
minibatch are drawn from the class counts and shared by its contexts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import cut, id_text, materialise, raw_texts, schema_of

#: Words that are classes of their own, and classes of the other words.
HEAD_WORDS, TAIL_CLASSES = 256, 256
CONTEXT, WIDTH = 2, 16
#: Words with more than this share of all tokens are known to every task: at most
#: 1 / COMMON_SHARE, whatever the input.
COMMON_SHARE = 3e-6
#: Passes over all training tokens, and the rounds that each is dealt out to.
PASSES, ROUNDS = 1, 4
MINIBATCH, NOISE, RATE = 1024, 32, 0.1
#: The end of a text among the words; no word holds white space.
END = b"\n"
#: Distinct words a task holds before it sends their counts on.
_HELD_WORDS = 400_000
_CHUNK_TOKENS = 1 << 18
_SUM_TASKS = 16
_LOG10 = math.log(10)


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


def _tail_class(word: str) -> Column:
    """``tail_class`` in Spark."""
    return F.expr(f"cast(crc32(substring({word}, greatest(length({word}) - 1, 1), 2)) % {TAIL_CLASSES} as int)")


def word_counts(rows: DataFrame) -> DataFrame:
    """``(word, n)``: how often each word, and the end, occurs in ``rows`` (id, text)."""

    def counted(batches):
        held, ends = Counter(), 0
        for b in batches:
            for text in raw_texts(b.column(1)):
                held.update(text.lower().split())  # bytes: ASCII letters and white space only
                ends += 1
                if len(held) >= _HELD_WORDS:
                    yield _count_batch(held)
                    held = Counter()
        if ends:
            held[END] += ends
            yield _count_batch(held)

    parts = rows.mapInArrow(counted, "word binary, n bigint")
    return materialise(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def _count_batch(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


@dataclass
class Vocabulary:
    """Classes and word statistics; the size does not depend on the input."""

    tokens: int  # of the training texts
    words: int  # distinct ones
    discount: float
    common: dict[bytes, int]
    head: list[bytes]
    class_tokens: np.ndarray
    class_words: np.ndarray  # distinct words; of a head class 1

    @classmethod
    def of(cls, counts: DataFrame) -> Vocabulary:
        one, two = (F.coalesce(F.sum((F.col("n") == k).cast("bigint")), F.lit(0)) for k in (1, 2))
        words, tokens, once, twice = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), one, two).first()
        common = {bytes(r.word): r.n for r in counts.where(F.col("n") > max(1, int(COMMON_SHARE * tokens))).collect()}
        top = counts.orderBy(F.desc("n"), "word").limit(HEAD_WORDS).collect()
        head = [bytes(r.word) for r in top]
        size = HEAD_WORDS + TAIL_CLASSES
        n, distinct = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for r in (counts.groupBy(_tail_class("word").alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
                  .collect()):  # one row a class
            n[HEAD_WORDS + r.k], distinct[HEAD_WORDS + r.k] = r.n, r.v
        for i, r in enumerate(top):
            k = HEAD_WORDS + tail_class(head[i])
            n[i], distinct[i] = r.n, 1
            n[k], distinct[k] = n[k] - r.n, distinct[k] - 1
        discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.05
        return cls(tokens, words, discount, common, head, n, distinct)

    def class_of(self) -> _Classes:
        return _Classes(self.head)

    def noise(self) -> np.ndarray:
        share = self.class_tokens + 1.0
        return share / share.sum()

    def base(self, n: int) -> float:
        """log10 of the add-one share of a word with ``n`` occurrences."""
        return math.log10((n + 1) / (self.tokens + self.words + 1))

    def inside(self, k: int, n: int) -> float:
        """log10 of the share of a word with ``n`` occurrences in its class."""
        if k < HEAD_WORDS:
            return 0.0
        if n:
            return math.log10((n - self.discount) / self.class_tokens[k])
        return math.log10(self.discount * self.class_words[k] / self.class_tokens[k]) if self.class_tokens[k] else 0.0

    def known(self) -> dict[bytes, tuple[float, float]]:
        """``base`` and ``inside`` of every common word."""
        n = np.array(list(self.common.values()), dtype=np.float64)
        classes = self.class_of()
        k = np.array([classes[w] for w in self.common], dtype=np.int64)
        base = np.log10((n + 1) / (self.tokens + self.words + 1))
        share = (n - self.discount) / np.maximum(1, self.class_tokens[k])
        inside = np.where(k < HEAD_WORDS, 0.0, np.log10(np.maximum(share, 1e-300)))
        return dict(zip(self.common, zip(base.tolist(), inside.tolist())))


class _Classes(dict):
    """Class numbers of words; starts anew when it is full."""

    def __init__(self, head):
        super().__init__({w: i for i, w in enumerate(head)})
        self._head = dict(self)

    def __missing__(self, word):
        if len(self) >= _HELD_WORDS:
            self.clear()
            self.update(self._head)
            if word in self._head:
                return self._head[word]
        k = self[word] = HEAD_WORDS + tail_class(word)
        return k


def encode(rows: DataFrame, learn: Column, vocabulary: Vocabulary) -> DataFrame:
    """One row per row of ``rows`` (id, text), as a table.

    ``row`` numbers the rows; ``learn`` is the condition on ``id``; ``ids`` holds
    the classes of all tokens; ``n_known``, ``base`` and ``inside`` cover the common
    words, and ``words`` with ``times`` the others, whose counts are still to be met.
    """
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id",
                           F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    schema = schema_of(row="bigint", id=rows.schema["id"].dataType, learn="boolean", n_tokens="bigint",
                       n_known="bigint", base="double", inside="double", ids="binary", words="array<binary>",
                       times="array<int>")

    def encoded(batches):
        classes = vocabulary.class_of()
        known = vocabulary.known()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                n_tokens, n_known, base, inside, ids, others, times, ends = [], [], [], [], [], [], [], [0]
                for text in raw_texts(part.column(3)):
                    words = text.lower().split()
                    words.append(END)
                    ids.append(np.fromiter(map(classes.__getitem__, words), "<u2", len(words)).tobytes())
                    found, left = [], 0
                    for w, n in Counter(words).items():
                        s = known.get(w)
                        if s is None:
                            others.append(w)
                            times.append(n)
                            left += n
                        else:
                            found.append((n * s[0], n * s[1]))
                    ends.append(len(others))
                    n_tokens.append(len(words))
                    n_known.append(len(words) - left)
                    base.append(math.fsum([x for x, _ in found]))
                    inside.append(math.fsum([x for _, x in found]))
                at_word = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), pa.array(n_tokens, pa.int64()),
                    pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(inside, pa.float64()),
                    pa.array(ids, pa.binary()), pa.ListArray.from_arrays(at_word, pa.array(others, pa.binary())),
                    pa.ListArray.from_arrays(at_word, pa.array(times, pa.int32()))], schema.fieldNames())

    return materialise(numbered.mapInArrow(encoded, schema), "lm-texts")


class LogBilinear:
    """Parameters of the class model and their squared gradients, in one vector."""

    def __init__(self, noise: np.ndarray, values: np.ndarray | None = None, width: int = WIDTH, context: int = CONTEXT):
        k = len(noise)
        self.noise, self.context = noise, context
        shapes = [(k, width), (k, width), (context, width, width), (k,)]
        ends = np.cumsum([math.prod(s) for s in shapes])
        if values is None:
            draw = np.random.default_rng(5)
            near = [draw.normal(0, 0.1, s).ravel() for s in shapes[:2]]
            start = [*near, np.tile(np.eye(width).ravel() / context, context), np.log(noise)]
            values = np.concatenate([*start, np.full(ends[-1], 1e-3)])
        self.values = values.astype(np.float32)
        halves = self.values[:ends[-1]], self.values[ends[-1]:]
        parts = [[x.reshape(s) for x, s in zip(np.split(h, ends[:-1]), shapes)] for h in halves]
        (self.inputs, self.outputs, self.places, self.bias), self.squares = parts

    def contexts(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Classes before each token, nearest first, and the token's own; a text
        begins after an end, whose class is the last of each text."""
        padded = np.concatenate([x for t in texts for x in (np.repeat(t[-1:], self.context), t)]).astype(np.int32)
        sizes = np.array([len(t) for t in texts])
        at = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(texts) + 1) * self.context, sizes)
        return np.stack([padded[at - 1 - i] for i in range(self.context)], axis=1), padded[at]

    def train(self, texts: list[np.ndarray], draw: np.random.Generator) -> None:
        """One pass of noise-contrastive minibatches with adaptive steps."""
        before, token = self.contexts(texts)
        order, ends = draw.permutation(len(token)), np.cumsum(self.noise)
        # With NOISE noise words a context, a word is data with odds p(word) / (NOISE noise(word)).
        odds = np.log(NOISE * self.noise).astype(np.float32)
        for s in range(0, len(order), MINIBATCH):
            at = order[s:s + MINIBATCH]
            x, y = before[at], token[at]
            z = np.minimum(np.searchsorted(ends, draw.random(NOISE)), len(ends) - 1)
            read = [self.inputs[x[:, i]] for i in range(self.context)]
            h = sum(r @ c for r, c in zip(read, self.places))
            out_y, out_z = self.outputs[y], self.outputs[z]
            g_y = _sigmoid((h * out_y).sum(axis=1) + self.bias[y] - odds[y]) - 1
            g_z = _sigmoid(h @ out_z.T + self.bias[z] - odds[z])
            g_h = g_y[:, None] * out_y + g_z @ out_z
            outputs = _scatter(self.outputs, np.concatenate([y, z]), np.concatenate([g_y[:, None] * h, g_z.T @ h]))
            bias = np.bincount(y, g_y, len(odds)) + np.bincount(z, g_z.sum(axis=0), len(odds))
            inputs = _scatter(self.inputs, x.T.ravel(), np.concatenate([g_h @ c.T for c in self.places]))
            places = np.stack([r.T @ g_h for r in read])
            for value, square, g in zip((self.inputs, self.outputs, self.places, self.bias), self.squares,
                                        (inputs, outputs, places, bias)):
                g = (g / len(at)).astype(np.float32)
                square += g * g
                value -= RATE * g / np.sqrt(square)

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text's classes, normalised over all classes;
        a context that occurs again is normalised once."""
        before, token = self.contexts(texts)
        place = len(self.noise) ** np.arange(self.context)
        _, first, which = np.unique(before @ place, return_index=True, return_inverse=True)
        h = sum(self.inputs[before[first, i]] @ c for i, c in enumerate(self.places))
        total, ones = np.empty(len(h)), np.ones(len(self.noise), np.float32)
        for s in range(0, len(h), 2048):
            scores = h[s:s + 2048] @ self.outputs.T
            scores += self.bias
            top = scores.max(axis=1, keepdims=True)
            scores -= top
            total[s:s + 2048] = np.log(np.exp(scores, out=scores) @ ones) + top[:, 0]
        own = np.einsum("ij,ij->i", h[which], self.outputs[token]) + self.bias[token]
        out = (own.astype(np.float64) - total[which]) / _LOG10
        return np.add.reduceat(out, np.cumsum([0, *[len(t) for t in texts[:-1]]]))


def _sigmoid(x):
    return 1 / (1 + np.exp(np.minimum(-x, 60)))


def _scatter(like, rows, values):
    """Sums of ``values`` by row number, in the shape of ``like``."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    out = np.zeros_like(like)
    out[rows[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def _texts(col: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in raw_texts(col)]


def train(encoded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, passes: int = PASSES) -> LogBilinear:
    """The model after ``passes`` passes over every training token, each in ``rounds`` shares."""
    model = LogBilinear(vocabulary.noise())
    share = F.pmod(F.xxhash64(F.lit("round"), "row"), F.lit(rounds))
    for k in range(rounds * passes):
        values, noise = model.values, model.noise

        def trained(batches):
            from pyspark import TaskContext

            own, part = LogBilinear(noise, values.copy()), TaskContext.get().partitionId()
            draw, seen = np.random.default_rng([k, part]), 0
            for b in batches:
                texts = _texts(b.column(0))
                for s in cut(texts, [len(t) for t in texts], _CHUNK_TOKENS):
                    own.train(texts[s], draw)
                    seen += sum(len(t) for t in texts[s])
            if seen:
                yield _weighed(part % _SUM_TASKS, seen, own.values.astype(np.float64) * seen)

        def added(batches):
            total, weight = None, 0
            for b in batches:
                for n, data in zip(b.column(1).to_pylist(), raw_texts(b.column(2))):
                    x = np.frombuffer(data, "<f8")
                    total, weight = x if total is None else total + x, weight + n
            if weight:
                yield _weighed(0, weight, total)

        schema = "slot int, n bigint, total binary"
        parts = (encoded.where(F.col("learn") & (share == k % rounds)).select("ids").mapInArrow(trained, schema)
                 .repartitionById(_SUM_TASKS, F.col("slot")).mapInArrow(added, schema)).collect()  # _SUM_TASKS rows at most
        if parts:
            total = sum(np.frombuffer(bytes(r.total), "<f8") for r in sorted(parts, key=lambda r: (r.n, bytes(r.total))))
            model = LogBilinear(noise, total / sum(r.n for r in parts))
    return model


def _weighed(slot, n, total):
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([n], pa.int64()),
                                       pa.array([total.tobytes()], pa.binary())], ["slot", "n", "total"])


def score(encoded: DataFrame, counts: DataFrame, vocabulary: Vocabulary, model: LogBilinear) -> DataFrame:
    """``(id, learn, n_tokens, n_known, train_tokens, base_score, score)`` per row."""
    fields = schema_of(row="bigint", id=encoded.schema["id"].dataType, learn="boolean", n_tokens="bigint",
                       n_known="bigint", base="double", score="double")
    values, noise = model.values, model.noise

    def scored(batches):
        own = LogBilinear(noise, values)
        for b in batches:
            texts = _texts(b.column(7))
            total = [own.log10(texts[s]) for s in cut(texts, [len(t) for t in texts], _CHUNK_TOKENS)]
            inside = b.column(6).to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(np.concatenate([*total, inside[:0]]) + inside)],
                                             fields.fieldNames())

    texts = encoded.select("row", "id", "learn", "n_tokens", "n_known", "base", "inside", "ids").mapInArrow(scored, fields)
    # Words that are not common, one row a text and word: none of them is hot.
    rest = encoded.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    met = rest.join(counts, F.col("words") == F.col("word"), "left")
    n, times = F.coalesce("n", F.lit(0)), F.col("times")
    tails = range(HEAD_WORDS, HEAD_WORDS + TAIL_CLASSES)
    of_class = _tail_class("words")
    shares = F.array(*[F.lit(math.log10(max(1, int(vocabulary.class_tokens[k])))) for k in tails])[of_class]
    unseen = F.array(*[F.lit(vocabulary.inside(k, 0)) for k in tails])[of_class]
    head = F.col("words").isin(vocabulary.head) if vocabulary.head else F.lit(False)
    inside = F.when(head, 0.0).when(n > 0, F.log10(n - vocabulary.discount) - shares).otherwise(unseen)
    base = F.log10((n + 1) / F.lit(float(vocabulary.tokens + vocabulary.words + 1)))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields[1:4]]
    words = met.select("row", *none, F.when(n > 0, times).otherwise(0).cast("bigint").alias("n_known"),
                       (times * base).alias("base"), (times * inside).alias("score"))
    whole = texts.union(words).groupBy("row").agg(
        *[F.max(c).alias(c) for c in ("id", "learn", "n_tokens")], *[F.sum(c).alias(c) for c in ("n_known", "base", "score")])
    return whole.select("id", "learn", "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
                        F.col("base").alias("base_score"), "score")


def language_model_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                          passes: int = PASSES) -> DataFrame:
    """Scores of every whole text by a model of those for which ``learn`` holds.

    ``learn`` is a condition on a column ``id`` (null: not learned from). Columns:
    ``id``, ``learn``, ``n_tokens`` (words and the end), ``n_known`` (tokens that a
    training text holds), ``train_tokens`` (tokens of all training texts),
    ``base_score`` (add-one unigram) and ``score`` (the model), both log10 of the
    text's probability. A null text counts as empty: one token, the end. Rows that
    repeat an id or have none each get a row. Without any training text all words
    are unseen and both scores are defined.
    """
    # Products here are small: a task should not take the cores of others.
    docs.sparkSession.sparkContext.environment.setdefault("OMP_NUM_THREADS", "1")
    rows = id_text(docs, id_col, text_col)
    counts = word_counts(rows.where(F.coalesce(learn, F.lit(False))))
    vocabulary = Vocabulary.of(counts)
    encoded = encode(rows, learn, vocabulary)
    return score(encoded, counts, vocabulary, train(encoded, vocabulary, passes=passes))
