import corpus_pipeline
import pytest
from corpus_rows import *  # noqa: F403  fixtures
from test_line_dedup import brute as brute_lines
from test_packing import check_packed

from tidewater.llm.common import materialise, read_table


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of each stage on the small tables."""
    docs, out = read_table(spark, SF_CHECK, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SF_CHECK), name)
        out[name] = (before, docs)
    return out


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns_and_order(stages, spark):
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "best_fit_packing"]
    columns = read_table(spark, SF_CHECK, "documents").columns
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "best_fit_packing")


def test_toxicity_drops_rows_only(stages, spark):
    before, after = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    assert set(rows_of(after)) < set(rows_of(before))
    gone = {i for i, _ in rows_of(before)} - {i for i, _ in rows_of(after)}
    assert sum(labels.get(i, 1) for i in gone) >= 0.95 * len(gone)


def test_line_dedup_matches_brute_force(stages):
    before, after = stages["line_dedup"]
    assert rows_of(after) == sorted((i, t) for i, _, _, t in brute_lines(rows_of(before), 10))
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_one_of_each_group_stays(stages, groups_of):
    from test_simhash import brute

    before, after = stages["simhash_near_dedup"]
    rows = rows_of(before)
    keep = {c for _, _, c in brute(rows, groups_of)}
    assert rows_of(after) == [x for x in rows if x[0] in keep] and len(keep) < len(rows)


def test_mixing_repeats_and_keeps_all(stages):
    before, after = stages["mixing"]
    assert set(rows_of(after)) == set(rows_of(before))
    assert after.count() > before.count()


def test_packing_holds_every_token(stages, spark):
    _, packed = stages["best_fit_packing"]
    rows = packed.collect()
    assert len(check_packed(rows, 2048)) <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF_CHECK)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = stages["best_fit_packing"][1]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            after = materialise(stage(spark, docs, SF_CHECK), name)
            if name != "best_fit_packing":
                assert after.columns == docs.columns
            docs = after
        assert (docs.count() > 0) == (name == "best_fit_packing" and docs.count() > 0)


def test_stages_keep_odd_rows(spark, odd_docs, odd_rows):
    from collections import Counter

    after = corpus_pipeline.drop_toxic(spark, odd_docs, SF_CHECK)
    assert Counter((r.doc_id, r.text) for r in after.collect()) == Counter(odd_rows)
    lines = corpus_pipeline.drop_frequent_lines(spark, odd_docs, SF_CHECK).collect()
    assert Counter((r.doc_id, r.text) for r in lines) == Counter((i, t or "") for i, t in odd_rows)
    mixed = corpus_pipeline.mix_to_targets(spark, odd_docs, SF_CHECK).collect()
    assert {(r.doc_id, r.text) for r in mixed} == set(odd_rows)
