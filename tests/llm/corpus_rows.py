import pytest

CLASHING = ["id", "row", "fp", "rep", "drop", "line_doc", "line_drop", "n_lines", "n_dropped", "tokens", "shares",
            "rate", "copies", "copy_number", "buckets", "scores", "score", "predicted", "passages", "whole_text",
            "kept_id", "removed", "text_hash", "unit_doc", "unit_row", "component_id", "piece", "block", "kind"]


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, empty and long texts, ties and repeated rows."""
    long = "\n".join(f"line {i % 700} of a long text. It goes on and on, again and again!" for i in range(20_000))
    return [
        (1, "one two three four five\nsame line\n  SAME line "), (2, "one two three four five\nsame line"),
        (2, "one two three four five\nsame line"), (2, "another text under the same id"),
        (3, None), (4, ""), (5, " \n\t\n"), (None, "no id\nsame line"), (None, "no id\nsame line"), (None, None),
        (6, long), (7, long), (8, "é ü ß 字 😀 \x00 \x1f mixed"), (9, "word"), (10, "word"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """``odd_rows`` with the columns of documents and extra ones with names in use inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"{c} string" for c in CLASHING)
    rows = [(i, t, None, "s", None, *["x"] * len(CLASHING)) for i, t in odd_rows]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def groups_of():
    """Smallest member reached by links, per node."""

    def find(nodes, links):
        parent = {n: n for n in nodes}

        def root(n):
            while parent[n] != n:
                parent[n] = parent[parent[n]]
                n = parent[n]
            return n

        for a, b in links:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        return {n: root(n) for n in nodes}

    return find


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
__all__ = ["CLASHING", "SF_CHECK", "SF_SMALL", "groups_of", "no_docs", "odd_docs", "odd_rows"]
