import zlib

import numpy as np
import pytest
from corpus_rows import *  # noqa: F403  fixtures
from test_packing import library  # noqa: F401  fixture

from tidewater.llm import token_files
from tidewater.llm.queries import op5_token_files


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_query_matches_library(spark, library):  # noqa: F811
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect())
    want, at = set(), 0
    for i, t in docs:
        ids = [*library(t or ""), 2]
        want.add((i, at, len(ids), crc(ids)))
        at += len(ids)
    got = op5_token_files(spark, SF_CHECK).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(docs)


def test_strings_of_added_tokens(spark, scratch, library):  # noqa: F811
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y\n", "<|endoftext|", "a <|ENDOFTEXT|> b", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    folder = scratch("docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    out = op5_token_files(spark, folder)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in out.schema] == [
        "doc_id bigint", "start bigint", "n_tokens bigint", "ids_crc32 bigint"]
    ids = [[*library(t or ""), 2] for t in texts]
    assert ids[0] == [64, 220, 50256, 275, 2]
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in out.orderBy("doc_id").collect()] == [
        (i, len(x), crc(x)) for i, x in enumerate(ids)]


def test_odd_rows(spark, odd_docs, odd_rows, scratch, library):  # noqa: F811
    out = scratch("tokens")
    token_files.write_token_files(odd_docs, out)
    rows = sorted(token_files.read_token_files(spark, out).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        at += r.n_tokens
    keys = [r.id for r in rows]
    assert keys == sorted(keys, key=lambda i: (i is not None, i))
    want = sorted(str((i, [*library(t or ""), 2])) for i, t in odd_rows)
    assert sorted(str((r.id, r.ids)) for r in rows) == want
    same_id = sorted(r.ids for r in rows if r.id == 2)
    assert sorted(token_files.read_document(spark, out, 2)) == same_id and len(same_id) == 3
    assert token_files.read_document(spark, out, 77) == []


def test_small_blocks_and_dictionary(spark, scratch, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_DOCS", 7)
    out = scratch("tokens")
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    token_files.write_token_files(docs, out)
    assert len(spark.read.parquet(f"{out}/dictionary").first().dictionary) > 1000
    rows = {r.id: r.ids for r in token_files.read_token_files(spark, out).collect()}
    assert len(rows) == docs.count()
    for i in (0, 13, 500, 999):
        assert token_files.read_document(spark, out, i) == [rows[i]]


def test_other_dictionary_is_refused(spark, scratch):
    out = scratch("tokens")
    token_files.write_token_files(spark.createDataFrame([(1, "a b")], "doc_id int, text string"), out)
    spark.createDataFrame([(b"x", "00", "<u2")], "dictionary binary, sha256 string, id_type string").write.mode(
        "overwrite").parquet(f"{out}/dictionary")
    with pytest.raises(ValueError, match="hash"):
        token_files.read_token_files(spark, out)


def test_empty_table(spark, no_docs, scratch):
    out = scratch("tokens")
    token_files.write_token_files(no_docs, out)
    assert token_files.read_token_files(spark, out).collect() == []
