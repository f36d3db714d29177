"""Line splitting and Unicode tokenising as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line terminators of a text file read line by line with
# universal newlines, and the letters and numbers assigned from Unicode 14 to
# 15.1, which the regular expressions of JDK 17 (Unicode 13) do not know.
LINE_BREAK = r"\r\n|\r|\n"
NEWER_WORD_RANGES = (
    (0x0870, 0x0887), (0x0889, 0x088e), (0x08b5, 0x08b5), (0x08c8, 0x08c9), (0x0c5d, 0x0c5d),
    (0x0cdd, 0x0cdd), (0x170d, 0x170d), (0x171f, 0x171f), (0x1b4c, 0x1b4c), (0x2c2f, 0x2c2f),
    (0x2c5f, 0x2c5f), (0x9ffd, 0x9fff), (0xa7c0, 0xa7c1), (0xa7d0, 0xa7d1), (0xa7d3, 0xa7d3),
    (0xa7d5, 0xa7d9), (0xa7f2, 0xa7f4), (0x10570, 0x1057a), (0x1057c, 0x1058a), (0x1058c, 0x10592),
    (0x10594, 0x10595), (0x10597, 0x105a1), (0x105a3, 0x105b1), (0x105b3, 0x105b9), (0x105bb, 0x105bc),
    (0x10780, 0x10785), (0x10787, 0x107b0), (0x107b2, 0x107ba), (0x10f70, 0x10f81), (0x11071, 0x11072),
    (0x11075, 0x11075), (0x1123f, 0x11240), (0x11740, 0x11746), (0x11ab0, 0x11abf), (0x11f02, 0x11f02),
    (0x11f04, 0x11f10), (0x11f12, 0x11f33), (0x11f50, 0x11f59), (0x12f90, 0x12ff0), (0x1342f, 0x1342f),
    (0x13441, 0x13446), (0x16a70, 0x16abe), (0x16ac0, 0x16ac9), (0x1aff0, 0x1aff3), (0x1aff5, 0x1affb),
    (0x1affd, 0x1affe), (0x1b11f, 0x1b122), (0x1b132, 0x1b132), (0x1b155, 0x1b155), (0x1d2c0, 0x1d2d3),
    (0x1df00, 0x1df1e), (0x1df25, 0x1df2a), (0x1e030, 0x1e06d), (0x1e290, 0x1e2ad), (0x1e4d0, 0x1e4eb),
    (0x1e4f0, 0x1e4f9), (0x1e7e0, 0x1e7e6), (0x1e7e8, 0x1e7eb), (0x1e7ed, 0x1e7ee), (0x1e7f0, 0x1e7fe),
    (0x2a6de, 0x2a6df), (0x2b735, 0x2b739), (0x2ebf0, 0x2ee5d), (0x31350, 0x323af),
)
# The complement of the Unicode word class (letters, numbers, underscore). Most
# lines lie below the first of the newer ranges; the class without them is faster.
_NEWER = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in NEWER_WORD_RANGES)
NON_WORD_RUN = rf"[^\p{{L}}\p{{N}}_{_NEWER}]+"
OLDER_NON_WORD_RUN = r"[^\p{L}\p{N}_]+"
MAYBE_NEWER = rf"[\x{{{NEWER_WORD_RANGES[0][0]:x}}}-\x{{10ffff}}]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_lines(text: Column | str) -> Column:
    """Array of the lines of ``text``.

    ``\\n``, ``\\r\\n`` and ``\\r`` all end a line; one terminator at the very
    end does not open an extra empty line (a file ``"a\\n"`` has one line).
    """
    body = F.regexp_replace(_c(text), r"(\r\n|\r|\n)\z", "")
    return F.split(body, LINE_BREAK)


def tokenize(line: Column | str) -> Column:
    """Words of a line: split on runs of non-word characters, empties dropped.

    Leading and trailing whitespace or punctuation only produce empty pieces,
    which are filtered, so no separate strip is needed.
    """
    line = _c(line)
    pieces = F.when(line.rlike(MAYBE_NEWER), F.split(line, NON_WORD_RUN)).otherwise(F.split(line, OLDER_NON_WORD_RUN))
    return F.filter(pieces, lambda w: w != F.lit(""))
