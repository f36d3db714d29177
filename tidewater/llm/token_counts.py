"""Unigram token counts with a trie over pre-tokens.

A pre-token is a run of characters that are not white space, with the word mark
of the vocabulary before it. Its tokens are those of the best path under unigram
scores, the log of a Zipf law over the vocabulary's ranks; among equal paths the
one with fewer tokens counts. Characters outside the vocabulary fall back to one
token a UTF-8 byte.

Distinct pre-tokens of many texts at a time are inserted in a trie in sorted order.
A trie node holds the forward score of its prefix, which is computed once for all
pre-tokens that share it; the node where a pre-token ends stores its count. Texts
then sum terminal counts. Each worker keeps the trie of its texts, so nothing is
shuffled and every word's path is found once however often it occurs.
"""

from __future__ import annotations

import math
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import column, cut, find_package, schema_of
from tidewater.llm.tokens import public_path

VOCABULARY = "piece_bpe_32k.model"
WORD_MARK = "▁"
#: Terminal counts held by a worker; beyond it the trie starts anew.
MAX_TERMINALS = 600_000
#: Nodes kept from one insertion to the next, about; beyond it the trie starts anew.
MAX_NODES = 400_000
_INSERT_CHARS = 1 << 22


class UnigramVocabulary:
    """Pieces with unigram log scores, and all their prefixes.

    ``prefixes`` maps a prefix of any piece to its score, or to None if it is no
    piece itself.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        total = math.log(sum(1 / (r + 2) for r in range(n)))
        self.scores: dict[str, float] = {}
        self.byte_score = -math.log(n + 2) - total
        for i in range(n):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)):
                self.scores[model.id_to_piece(i)] = -math.log(i + 2) - total
        self.prefixes: dict[str, float | None] = {p[:n]: None for p in self.scores for n in range(1, len(p))}
        self.prefixes.update(self.scores)


class PrefixTrie:
    """Terminal counts of pre-tokens; forward scores are shared along prefixes.

    Nodes are numbers. A node has the best score of its prefix, that path's tokens,
    and the depths from which the prefix goes on being a prefix of some piece;
    ``_next`` leads from a node and a character to the node below. Nodes stay from
    one insertion to the next, so a prefix is scored once for all pre-tokens that
    share it; beyond ``MAX_NODES`` the trie starts anew, and terminal counts stay.
    (Plain lists of numbers, as Python's collector would go through millions of
    small containers again and again.)
    """

    def __init__(self, vocabulary: UnigramVocabulary):
        self.vocabulary = vocabulary
        self.counts: dict[str, tuple[int, float]] = {}
        self.nodes = 0
        self._clear()

    def _clear(self) -> None:
        self._best, self._tokens, self._alive, self._next = [0.0], [0], [()], {}

    def insert(self, words) -> None:
        """Add distinct pre-tokens (without the mark) that are not in yet."""
        if len(self._best) > MAX_NODES:
            self._clear()
        best, tokens, alive, below = self._best, self._tokens, self._alive, self._next
        prefixes, byte_score = self.vocabulary.prefixes.get, self.vocabulary.byte_score
        path, last, before = [0], "", len(best)
        for word in sorted(words):  # neighbours share most of their path
            marked = WORD_MARK + word
            shared = len(os.path.commonprefix([last, marked]))
            del path[shared + 1:]
            node = path[-1]
            for j in range(shared + 1, len(marked) + 1):
                c = marked[j - 1]
                step = node << 21 | ord(c)
                node = below.get(step)
                if node is None:
                    node = below[step] = len(best)
                    above = path[-1]
                    top, n, still = None, 0, []
                    for i in (*alive[above], j - 1):
                        s = prefixes(marked[i:j], 0)
                        if s == 0:  # no prefix of a piece (scores are below zero)
                            continue
                        still.append(i)
                        if s is not None:
                            at = path[i]
                            s += best[at]
                            if top is None or s > top or (s == top and tokens[at] < n - 1):
                                top, n = s, tokens[at] + 1
                    size = 1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4
                    s = best[above] + size * byte_score
                    if top is None or s > top:
                        top, n = s, tokens[above] + size
                    best.append(top)
                    tokens.append(n)
                    alive.append(tuple(still))
                path.append(node)
            last = marked
            self.counts[word] = (tokens[node], best[node])
        self.nodes += len(best) - before


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None) -> DataFrame:
    """``(id, n_words, n_tokens, log_score)`` per row of ``docs``.

    Whole texts are counted. A null or empty text, or one of white space only,
    has no words and no tokens and a score of zero. Rows that repeat an id each
    get a row.
    """
    find_package(docs.sparkSession)
    path = vocabulary or public_path(VOCABULARY)
    rows = docs.select(column(docs, id_col).alias("id"),
                       F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"))
    schema = schema_of(id=rows.schema["id"].dataType, n_words="bigint", n_tokens="bigint", log_score="double")

    def counted(batches):
        trie = _trie(path)
        counts = trie.counts
        for b in batches:
            n_words, n_tokens, score = [], [], []
            texts = b.column(1).to_pylist()
            # The new pre-tokens of many texts go in together, sorted.
            for part in cut(texts, [len(t) for t in texts], _INSERT_CHARS):
                split = [t.split() for t in texts[part]]
                words = set().union(*split)
                new = words - counts.keys()
                if len(counts) + len(new) > MAX_TERMINALS and counts:
                    counts.clear()
                    new = words
                trie.insert(new)
                for found in split:
                    found = [counts[w] for w in found]
                    n_words.append(len(found))
                    n_tokens.append(sum([c for c, _ in found]))
                    score.append(math.fsum([s for _, s in found]))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64()),
                pa.array(np.array(score, dtype=np.float64))], schema.fieldNames())

    return rows.mapInArrow(counted, schema)


_TRIES: dict[str, PrefixTrie] = {}


def _trie(path: str) -> PrefixTrie:
    """The worker's trie of a vocabulary; it lives as long as the worker."""
    if path not in _TRIES:
        _TRIES[path] = PrefixTrie(UnigramVocabulary(path))
    return _TRIES[path]
