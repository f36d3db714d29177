"""Token ids of whole texts with the tokenizers library."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidewater.llm.common import cut

#: Entries kept a worker; beyond it a cache starts anew. Words that were met again
#: since the last start are kept over the next.
CACHE_CHUNKS = 50_000
CACHE_WORDS = 300_000
#: Characters of texts that are encoded together, unless one text has more.
SLICE_CHARS = 1 << 23
_MARKS = ".,;:!?"
#: The places to cut a text with a blank after white space.
_CUTS = re.compile(r"(?<=\S)(?=[ \t\n])")
_PARAGRAPH = re.compile(r"\n(?: \n)+")
#: Latin letters and closing marks, after a blank, a line end or nothing.
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_PLAIN = re.compile(rf"([ \n]?)({_LATIN.pattern})([{_MARKS}]*)")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Words(dict):
    """Ids of words in the byte-level alphabet, by the library's model; a word
    may begin with a plain blank."""

    def __init__(self, model, most):
        super().__init__()
        self._tokenize, self._most, self._before = model.tokenize, most, {}

    def __missing__(self, word):
        ids = self._before.get(word)
        if ids is None:
            spelt = "Ġ" + word[1:] if word[:1] == " " else word
            ids = array("I", [t.id for t in self._tokenize(spelt)]).tobytes()
        if len(self) >= self._most:
            self._before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class _Chunks(dict):
    """Ids of a chunk, with the white space before it."""

    def __init__(self, encode, most):
        super().__init__()
        self._encode, self._most = encode, most

    def __missing__(self, chunk):
        if len(self) >= self._most:
            self.clear()
        ids = self[chunk] = self._encode(chunk)
        return ids


class CachedTokenizer:
    """Ids of texts as bytes, unsigned 32-bit in this machine's (little) order.

    The byte-level BPE splits a text into words by a fixed pattern first, and no
    alternative of that pattern goes from a character that isn't white space on
    to white space. So a text can be cut before each blank or line end that follows
    such a character, and the ids of the text are those of its chunks in turn.
    Chunks repeat far more often than texts, so those of many texts are numbered
    by Arrow and each distinct one is encoded once; the ids of their words are kept
    from then on. The pattern cuts a chunk of Latin letters and closing marks
    after a line end and before the marks; every other chunk is split by the
    library. A text that holds the string of an added token, such as an end of
    text, is left to the library whole, which gives that token's id.
    """

    def __init__(self, path: str, chunks: int = CACHE_CHUNKS, words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        self._split = lib.pre_tokenizer.pre_tokenize_str
        self._words = _Words(lib.model, words)
        self._chunks = _Chunks(self._encode, chunks)
        self._letters = _byte_letters()
        self._library = lib.encode
        added = [t.content for t in lib.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added)) or "(?!)")

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for s in cut(texts, map(len, texts), SLICE_CHARS):
            out += self._texts(texts[s])
        return out

    def _texts(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts: a number for each chunk, then the ids by number.

        Chunks are cut at blanks, which they lose, and before line ends, where a
        blank is set first; one that begins with a line end had no blank.
        """
        spaced = [t.replace("\n", " \n") for t in texts]
        spaced = [_PARAGRAPH.sub(lambda m: m[0].replace(" ", ""), t) if "\n \n" in t else t for t in spaced]
        pieces = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        offsets, coded = pieces.offsets.to_numpy(), pieces.flatten().dictionary_encode()
        codes, n = coded.indices.to_numpy().copy(), len(coded.dictionary)
        ids, blank = self._distinct(coded.dictionary)
        # The first chunk of a text has no blank before it.
        firsts = [t.partition(" ")[0] for t in spaced]
        codes[offsets[:-1]] = np.arange(n, n + len(texts))
        ids += map(self._encode, firsts)
        blank += [n + i for i, c in enumerate(firsts) if c[-1:].isspace()]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, sizes = np.cumsum(lengths) - lengths, lengths[codes]
        ends = np.cumsum(sizes)
        at = np.repeat(starts[codes] - (ends - sizes), sizes) + np.arange(ends[-1])
        found = np.frombuffer(b"".join(ids), np.uint32)[at].tobytes()
        stops = (4 * ends[offsets[1:] - 1]).tolist()
        out = [found[a:b] for a, b in zip([0, *stops], stops)]
        for i in self._odd(offsets, codes, blank, len(ids)):
            out[i] = b"".join(map(self._chunks.__getitem__, _CUTS.split(texts[i])))
        for i, text in enumerate(texts):
            if self._added.search(text):
                out[i] = array("I", self._library(text, add_special_tokens=False).ids).tobytes()
        return out

    def _distinct(self, chunks: pa.Array) -> tuple[list[bytes], list[int]]:
        """Ids of each chunk, with a blank before it unless it begins with a line end;
        the numbers of those that are empty or end with white space."""
        ids, blank, words, kept = [], [], self._words, self._chunks
        # No chunk holds a blank.
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(chunks)], chunks.cast(pa.string())), " ")
        for i, chunk in enumerate(joined[0].as_py().split(" ")):
            word = chunk.rstrip(_MARKS)
            if word.isalpha() and (plain := word.isascii() or _LATIN.fullmatch(word)):
                found = words[" " + (word if plain is True else self._spelt(word))]
                ids.append(found if len(word) == len(chunk) else found + words[chunk[len(word):]])
            else:
                ids.append(kept[chunk if chunk[:1] == "\n" else " " + chunk])
                if not chunk or chunk[-1].isspace():
                    blank.append(i)
        return ids, blank

    @staticmethod
    def _odd(offsets: np.ndarray, codes: np.ndarray, blank: list[int], n: int) -> list[int]:
        """The texts with a blank after white space: after a chunk that is empty
        or ends so and isn't the text's last."""
        if not blank:
            return []
        marked = np.zeros(n, bool)
        marked[blank] = True
        marked = marked[codes]
        marked[offsets[1:] - 1] = False
        return np.unique(np.searchsorted(offsets, np.flatnonzero(marked), "right") - 1).tolist()

    def _spelt(self, word: str) -> str:
        """Letters in the byte-level alphabet."""
        return word.encode().decode("latin-1").translate(self._letters)

    def _encode(self, chunk: str) -> bytes:
        words, plain = self._words, _PLAIN.fullmatch(chunk)
        if plain is None:
            return b"".join([words[w] for w, _ in self._split(chunk)])
        before, word, marks = plain.groups()
        word = word if word.isascii() else self._spelt(word)
        ids = words["Ċ"] + words[word] if before == "\n" else words[before + word]
        return ids + words[marks] if marks else ids


_LOADED: dict[str, CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    """The worker's tokenizer of a path; its cache lives as long as the worker."""
    if path not in _LOADED:
        _LOADED[path] = CachedTokenizer(path)
    return _LOADED[path]


def id_type(path: str) -> str:
    """The narrowest unsigned type that holds the ids of a vocabulary."""
    import json

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    return "<u2" if len(vocab) < 60_000 else "<u4"
