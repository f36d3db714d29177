import operator

import numpy as np
from corpus_rows import *  # noqa: F403  fixtures
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewater.llm import topk
from tidewater.llm.queries import op9_exact_top_k


def brute(rows, queries, k):
    """(query, rank, id, score) with Python's whole numbers."""
    import math

    x = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
         if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    out = []
    for a, (q, of) in enumerate(x):
        if queries(q):
            scores = sorted((-max(-2**63, min(2**63 - 1, sum(map(operator.mul, of, v)))), i)
                            for b, (i, v) in enumerate(x) if a != b)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = op9_exact_top_k(spark, "/root/testdata/sf0.1").collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 50 == 0, 5)


def test_many_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_MEMBERS", 60)
    draw = np.random.default_rng(4)
    rows = [(int(i), [float(v) for v in draw.integers(-2, 3, 6) / 4]) for i in draw.permutation(700)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = topk.top_k(vectors, F.expr("id % 7 = 0"), k=9).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 7 == 0, 9)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, []), (3, [float("nan")]), (4, [float("inf"), 0.0]), (5, [None, 1.0]),
            (None, [1.0]), (6, [1e16, 1e16]), (7, [-1e200, 3.0]), (8, [0.3]), (9, [2.0, 1.0]), (9, [2.0, 1.0]), (9, [3.0]),
            (10, [-48.0, 0.0]), (10, [48.0, 48.0])]
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                    "vec_id bigint, embedding array<double>, id string, block int")
    got = topk.top_k(vectors, F.lit(True), k=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: True, 5)
    assert topk.top_k(vectors.limit(0), F.lit(True)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=2, max_size=40))
def test_bounds_hold(vectors):
    x = np.array(vectors, dtype=float)
    file = topk.VectorFile(np.arange(len(x)), x)
    assert (file.bounds(x) >= x @ file.x.T).all()
