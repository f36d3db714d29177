import __spark_entry__
import pytest
from corpus_rows import *  # noqa: F403  fixtures
from pyspark.sql.functions import lit
from tools.check_oracle import compare

from tidewater.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_an_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    res = compare(spark, SF_CHECK, [name], verbose=True)[name]
    assert res["ok"], res


CONTRACT = {
    "op1_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op3_embedding_near_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op4_simhash_near_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op5_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op7_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                            "sequence_id bigint, offset bigint",
    "op9_exact_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op10_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11_language_model": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                           "base_score double, score double",
    "op12_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
                          "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op13_fill_middle": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                        "output_sha256 string, restored_sha256 string",
}


@pytest.fixture(scope="module")
def clashing_tables(spark, tmp_path_factory):
    """The small tables with extra columns of every name in use inside."""
    folder = str(tmp_path_factory.mktemp("clash"))
    for name in ("documents", "embeddings", "labels"):
        rows = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")  # noqa: F405
        for i, extra in enumerate([*CLASHING, "v", "row_number", "learn", "base", "inside", "words", "times",  # noqa: F405
                                   "n", "form", "output", "restored", "runs", "collapsed", "first", "start", "length",
                                   "period", "g", "a", "p", "width", "key", "member", "features", "held_out", "node"]):
            if extra not in rows.columns:
                rows = rows.withColumn(extra, lit(-7 - i))
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract_columns_and_clashing_names(spark, clashing_tables, name):
    plain = QUERIES[name](spark, SF_SMALL)  # noqa: F405
    schema = [f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields]
    for column in CONTRACT.get(name, "").split(", "):
        assert not column or column in schema
    clash = QUERIES[name](spark, clashing_tables)
    assert clash.schema == plain.schema
    if name == "op7_best_fit_packing":  # any sequence numbers will do
        plain, clash = (df.drop("sequence_id", "offset") for df in (plain, clash))

    def rows(df):
        return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())

    assert rows(clash) == rows(plain)
