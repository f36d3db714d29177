import hashlib
from collections import Counter, defaultdict

import numpy as np
from corpus_rows import *  # noqa: F403  fixtures
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewater.llm.common import id_text
from tidewater.llm.line_dedup import PerfectHash, dedup_lines, frequent_lines
from tidewater.llm.queries import op1_line_dedup


def brute(rows, min_docs, min_chars=1):
    """Per row (id, lines, dropped, kept text)."""
    key = lambda line: line.strip(b" \t\n\x0b\x0c\r").lower()
    found = defaultdict(set)
    for i, t in rows:
        for line in (t or "").encode().split(b"\n"):
            found[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x in lines
                if len(key(x).decode()) < min_chars or len(found[key(x)]) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
    return out


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    want = {(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs, 10)}
    got = op1_line_dedup(spark, SF_CHECK).collect()
    assert len(got) == len(docs) and {tuple(r) for r in got} == want
    assert sum(r.n_dropped for r in got) > 100


def test_odd_rows(odd_docs, odd_rows):
    out = dedup_lines(odd_docs, min_docs=2)
    assert out.columns[:-2] == odd_docs.columns
    assert out.columns[-2:] == ["n_lines_", "n_dropped_"]
    got = Counter((r.doc_id, r["n_lines_"], r["n_dropped_"], r.text) for r in out.collect())
    assert got == Counter(brute(odd_rows, 2))


def test_minimum_length_counts_code_points(spark):
    rows = [(1, "é\nab"), (2, "é\nab"), (3, "字字\nx")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in dedup_lines(docs, min_docs=2, min_chars=2).collect())
    assert got == Counter(brute(rows, 2, 2))


def test_empty_table(no_docs):
    assert dedup_lines(no_docs).collect() == []


def test_many_shards(spark, monkeypatch, odd_docs, odd_rows):
    import tidewater.llm.line_dedup as module

    monkeypatch.setattr(module, "SHARD_KEYS", 50)
    monkeypatch.setattr(module, "COMMON_SHARE", 0.3)
    got = Counter((r.doc_id, r["n_dropped_"], r.text) for r in dedup_lines(odd_docs, min_docs=2).collect())
    assert got == Counter((i, d, t) for i, _, d, t in brute(odd_rows, 2))


@settings(max_examples=50, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1)), max_size=300))
def test_perfect_hash_is_minimal_and_exact(keys):
    keys = sorted(keys)
    hi, lo = (np.array([k[i] for k in keys], dtype=np.uint64) for i in (0, 1))
    counts = np.arange(1, len(keys) + 1)
    index = PerfectHash.from_bytes(PerfectHash.build(hi, lo, counts).to_bytes())
    assert len(index.counts) == len(keys)
    assert index.counts_of(hi, lo).tolist() == counts.tolist()
    other = lo ^ np.uint64(1)
    new = [i for i in range(len(keys)) if (int(hi[i]), int(other[i])) not in set(keys)]
    assert not index.counts_of(hi[new], other[new]).any()


def test_rows_without_an_id_have_lists_of_their_own(spark):
    rows = [(None if k % 2 else 5, f"common {k % 40}\ncommon {(k + 1) % 40}\nown {k}") for k in range(400)] + [
        (1000 + k, "\n".join(f"common {j}" for j in range(40))) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = dedup_lines(docs, min_docs=3)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect())
    assert got == Counter(brute(rows, 3))
    texts = id_text(docs, "doc_id", "text")
    marked = texts.select(F.xxhash64("id", "text").alias("id"), "text")
    lists = frequent_lines(texts, marked, 3, 1).distinct().groupBy("id").count()
    assert lists.agg(F.max("count")).first()[0] == 40  # a text's own lines; two for those that share an id
    assert lists.where("count > 2").count() == 3
