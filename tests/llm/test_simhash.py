import numpy as np
import pytest
import xxhash
from corpus_rows import *  # noqa: F403  fixtures
from hypothesis import given, settings, strategies as st

from tidewater.llm import simhash
from tidewater.llm.queries import op4_simhash_near_dedup


def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k:k + 4]), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, groups_of, reach=4):
    fps = [plain_fingerprint(t or "") for _, t in rows]
    linked = [k for k, (i, _) in enumerate(rows) if i is not None]
    values = np.array([fps[k] for k in linked], dtype=np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= reach
    group = groups_of([rows[k][0] for k in linked],
                      [(rows[linked[a]][0], rows[linked[b]][0]) for a, b in zip(*np.nonzero(near))])
    return [(i, f, None if i is None else group[i]) for (i, _), f in zip(rows, fps)]


def test_query_matches_brute_force(spark, groups_of):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    want = {(i, f"{f:016x}", c) for i, f, c in brute(docs, groups_of)}
    got = {tuple(r) for r in op4_simhash_near_dedup(spark, SF_CHECK).collect()}
    assert got == want
    assert len({c for _, _, c in got}) < len(got)


def test_odd_rows(odd_docs, odd_rows, groups_of):
    got = sorted(((r.id, r.fp % 2**64, r.component_id) for r in simhash.simhash_components(odd_docs).collect()), key=str)
    # Rows that share an id are one node of the brute force, so both links count.
    want = sorted(brute(odd_rows, groups_of), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert {g[0]: g[2] for g in got if g[0] != 2} == {w[0]: w[2] for w in want if w[0] != 2}


def test_keep_one(odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 6, 8, 9]
    assert ids.count(None) == 3
    assert simhash.keep_one(no_docs).collect() == []
    assert simhash.simhash_components(no_docs).collect() == []


def linked_rows(spark, values, groups_of, reach=4):
    """Groups by ``hamming_links`` and by all pairs."""
    rows = [(int(v), k) for k, v in enumerate(values.view(np.int64))]
    found = simhash.hamming_links(spark.createDataFrame(rows, "fp bigint, rep bigint"), reach).collect()
    linked = np.bitwise_count(values[:, None] ^ values[None, :]) <= reach
    nodes = range(len(values))
    return groups_of(nodes, [(r.a, r.b) for r in found]), groups_of(nodes, zip(*np.nonzero(linked)))


def clusters(seed, n=900, hot=300, flips=2):
    """Unrelated fingerprints, neighbours of some of them, and a cluster around one."""
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 2**63, n, dtype=np.uint64)

    def flipped(x, times):
        for _ in range(times):
            x = x ^ (np.uint64(1) << draw.integers(0, 64, len(x)).astype(np.uint64))
        return x

    return np.unique(np.concatenate([base, flipped(base[:n // 3], 1), flipped(base[n // 3:n // 2], 4),
                                     flipped(np.repeat(base[:1], hot), flips)]))


@pytest.mark.parametrize("members", [4_096, 64, 16])
def test_many_shards_and_blocks(spark, monkeypatch, groups_of, members):
    monkeypatch.setattr(simhash, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(simhash, "SAMPLE", 200)
    got, want = linked_rows(spark, clusters(5, flips=4), groups_of)
    assert got == want


@pytest.mark.parametrize("most", [2**-6, 2**-16, 2**-22])
def test_more_segments(spark, monkeypatch, groups_of, most):
    monkeypatch.setattr(simhash, "segment_masks", lambda n, reach, of=simhash.segment_masks: of(int(n / most), reach))
    got, want = linked_rows(spark, clusters(6), groups_of)
    assert got == want


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=6), st.integers(1, 2**40), st.integers(1, 6))
def test_close_fingerprints_share_a_choice(value, flips, n, reach):
    other = value
    for bit in flips:
        other ^= 1 << bit
    shared = any(value & m == other & m for m in simhash.segment_masks(n, reach))
    assert shared or len(flips) > reach


def test_rows_grow_with_the_fingerprints():
    assert [len(simhash.segment_masks(n, 4)) for n in (10, 50_000, 1_000_000, 100_000_000, 10**11)] == [5, 5, 5, 15, 70]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.integers(0, 2**16 - 1))
def test_tree_reaches_every_near_point(values, flips):
    points = np.unique(np.array(values, dtype=np.uint64))
    tree = simhash.VantageTree(points, 8, 4)
    home = tree.home(points)
    queries = points ^ np.uint64(flips & 0b1010000000000101)
    reached = {leaf: set(rows.tolist()) for leaf, rows in tree.reached(queries)}
    for q in range(len(queries)):
        for p in np.flatnonzero(np.bitwise_count(points ^ queries[q]) <= 4):
            assert q in reached[home[p]]
