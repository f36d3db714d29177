import numpy as np
from corpus_rows import *  # noqa: F403  fixtures

from tidewater.llm import embeddings
from tidewater.llm.queries import op3_embedding_near_dedup

NAN, INF = float("nan"), float("inf")


def brute(rows, groups_of, threshold=0.9):
    """Per row (id, links, component) for vectors padded with zeros."""
    width = max((len(v) for _, v in rows if v), default=1)

    def usable(i, v):
        return i is not None and v is not None and None not in v and all(np.isfinite(v)) and any(v)

    good = [k for k, (i, v) in enumerate(rows) if usable(i, v)]
    x = np.zeros((len(good), width))
    for n, k in enumerate(good):
        x[n, :len(rows[k][1])] = rows[k][1]
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    group = groups_of({rows[k][0] for k in good},
                      [(rows[good[a]][0], rows[good[b]][0]) for a, b in zip(*np.nonzero(linked))])
    links = dict(zip(good, linked.sum(axis=1).tolist()))
    return [(i, links.get(k, 0), group[i] if k in links else i) for k, (i, _) in enumerate(rows)]


def clusters(n, groups, copies, seed=3, dim=24):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, dim))
    centers = draw.normal(size=(groups, dim))
    for k in range(groups * copies):
        x[k] = centers[k % groups] + draw.normal(size=dim) * (0.05 + 0.3 * draw.random())
    x[-40:] = x[-1]
    return [(int(i), [float(v) for v in np.float32(row)]) for i, row in zip(draw.permutation(n), x)]


def test_recall_is_exact_on_clusters(spark, groups_of, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_MEMBERS", 100)
    rows = clusters(1500, 12, 60)
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    want = {(i, n, c, i == c) for i, n, c in brute(rows, groups_of)}
    for deviations in (embeddings.DEVIATIONS, None):
        got = embeddings.embedding_components(vectors, deviations=deviations).collect()
        found, wanted = sum(r.n_links for r in got), sum(n for _, n, _, _ in want)
        assert found >= 0.99 * wanted and found <= wanted
        if deviations is None:
            assert {tuple(r) for r in got} == want


def test_query_matches_brute_force(spark, groups_of):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = op3_embedding_near_dedup(spark, "/root/testdata/sf0.1").collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == set(brute(rows, groups_of))


def test_odd_rows(spark, groups_of):
    rows = [(1, [1.0, 0.0]), (2, [1.0]), (2, [2.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [NAN, 1.0]),
            (7, [INF, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1e300, 0.0]), (9, [1e300, 0.0]),
            (10, [0.0, 1e-300, 0.0]), (11, [0.0, 1.0]), (12, [-1.0, -0.0])]
    extra = [(i, v, "x", "y", 1) for i, v in rows]
    vectors = spark.createDataFrame(extra, "vec_id bigint, embedding array<double>, id string, v string, rep int")
    got = embeddings.embedding_components(vectors, deviations=None).collect()
    key = lambda r: str(r)
    assert sorted(((r.id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute(rows, groups_of), key=key)
    assert all(r.kept == (r.id == r.component_id) for r in got)
    assert embeddings.embedding_components(vectors.limit(0)).collect() == []


def recall(spark, rows, groups_of, **more):
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = embeddings.embedding_components(vectors, **more).collect()
    wanted = {i: n for i, n, _ in brute(rows, groups_of)}
    assert all(r.n_links <= wanted[r.id] for r in got) and len(got) == len(rows)
    return sum(r.n_links for r in got) / sum(wanted.values())


def test_recall_by_default_on_even_uneven_and_long_rows(spark, groups_of, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_MEMBERS", 200)
    draw = np.random.default_rng(9)
    even = clusters(3000, 60, 20, dim=64)
    # Nearly all variation lies in six of 64 directions.
    scale = np.where(np.arange(64) < 6, 1.0, 0.05)
    uneven = [(i, [float(v) for v in np.float32(np.array(x) * scale)]) for i, x in even]
    long = [*even, (9_000, [float(v) for v in draw.normal(size=4096)])]
    for rows in (even, uneven, long):
        assert recall(spark, rows, groups_of) >= 0.99


def test_long_rows_meet_each_other_exactly(spark, groups_of, monkeypatch):
    monkeypatch.setattr(embeddings, "LONG_ROWS", 0.2)
    draw = np.random.default_rng(10)
    base = draw.normal(size=(30, 200))
    rows = [(i, x.tolist()) for i, x in enumerate(np.repeat(base, 4, axis=0) + 0.1 * draw.normal(size=(120, 200)))]
    rows = [(i, x[:150 + i % 50]) for i, x in rows] + [
        (1_000 + i, (x * (1 if k % 2 else 0.2)).tolist()) for i, (k, x) in enumerate(
            (k, draw.normal(size=8) + 3 * (np.arange(8) == k % 8)) for k in range(700))]
    rows += [(5_000 + i, x[:8]) for i, (_, x) in enumerate(rows[:40])]  # like the start of a long row
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    width = vectors.selectExpr("percentile_approx(size(embedding), 0.8, 10000)").first()[0]
    assert width == 8
    got = embeddings.embedding_components(vectors, deviations=None).collect()
    assert {(r.id, r.n_links, r.component_id) for r in got} == set(brute(rows, groups_of))


def test_ids_of_a_stride_fill_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_MEMBERS", 50)
    draw = np.random.default_rng(12)
    x = draw.normal(size=(1200, 8))
    rows = [(int(i) * 1024, [float(v) for v in row]) for i, row in enumerate(np.float32(x))]
    routed = {}
    search = embeddings.search_blocks

    def sizes(routes, n_blocks, make, schema):
        routed.update({r.block: r.n for r in routes.where("kind = 0").groupBy("block").agg(
            {"rep": "count"}).withColumnRenamed("count(rep)", "n").collect()})
        routed["blocks"] = n_blocks
        return search(routes, n_blocks, make, schema)

    monkeypatch.setattr(embeddings, "search_blocks", sizes)
    embeddings.embedding_components(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    blocks = routed.pop("blocks")
    assert len(routed) >= 0.9 * blocks and max(routed.values()) <= 2 * 50
