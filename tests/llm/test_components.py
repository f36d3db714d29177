import random

from corpus_rows import *  # noqa: F403  fixtures

from tidewater.llm.components import connected_components


def test_matches_union_find(spark, groups_of):
    draw = random.Random(3)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(200)] + [(5, 5), (7, None)]
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    links = [(a, b) for a, b in links if b is not None and a != b]
    want = groups_of({n for x in links for n in x}, links)
    smallest = {n for n, c in want.items() if n == c}
    assert {r.node: r.component for r in got.collect()} == {n: c for n, c in want.items() if n not in smallest}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
