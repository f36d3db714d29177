"""Registered queries of the subpackage: one an operator, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import (
    embeddings, fill_middle, language_model, line_dedup, mixing, packing, periodic_runs, simhash, substring_dedup,
    token_counts, token_files, topk, toxicity,
)
from tidewater.llm.common import read_table
from tidewater.llm.oracle import ORACLE_SQL
from tidewater.session import scratch_path


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that queries read; the names of any others mean nothing here."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_texts(spark, sf_dir), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", line_dedup.sha256_hex("text").alias("kept_sha256"))


#: Shares of the expected tokens by domain.
TARGETS = {"clean": 0.80, "low": 0.15, "toxic": 0.05}


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _texts(spark, sf_dir), read_table(spark, sf_dir, "labels")
    mixed = mixing.mix(docs, mixing.label_domains(labels), TARGETS)
    shares = [(F.element_at("shares", i + 1) / mixing.GRAIN).alias(f"p_{d}") for i, d in enumerate(TARGETS)]
    return mixed.select("doc_id", F.col("tokens").alias("n_tokens"), *shares, "rate", "copies")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_components(_vectors(spark, sf_dir), threshold=0.9).withColumnRenamed("id", "vec_id")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(_texts(spark, sf_dir), words=4, reach=4)
    return out.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    token_files.write_token_files(_texts(spark, sf_dir), out)
    return token_files.read_token_files(spark, out).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_texts(spark, sf_dir), min_words=20)
    return out.select(
        "doc_id", F.size("removed").alias("n_removed"),
        F.expr("aggregate(removed, 0L, (n, x) -> n + x.end - x.start)").alias("removed_chars"),
        F.expr("array_sort(array_distinct(transform(removed, x -> x.first_id)))").alias("first_doc_ids"),
        "removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(_texts(spark, sf_dir))
    return packing.pack(pieces).withColumnRenamed("id", "doc_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_texts(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_vectors(spark, sf_dir), F.expr("id % 50 = 0"), k=5)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _texts(spark, sf_dir), read_table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score_toxicity(docs, model, threshold=0.3, keep=("doc_id",))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    out = language_model.language_model_scores(docs, ~held_out)
    return out.select(F.col("id").alias("doc_id"), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")


def _planted_repeats(docs: DataFrame) -> DataFrame:
    """A tenth of the documents with their words from a drawn place on replaced by
    repeats of the first few of these words; all others as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", (F.floor(h / 10)).alias("g"), F.when(h % 10 == 0, split).alias("words"))
    n = F.size("words")
    rows = rows.withColumn("n", n).withColumn("a", F.col("g") % F.nullif("n", F.lit(0)))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.expr(
        "concat_ws(' ', slice(words, 1, int(a)), "
        "slice(flatten(array_repeat(slice(words, int(a) + 1, int(p)), int(ceil((n - a) / p)))), 1, int(n - a)))"
    )).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _planted_repeats(_texts(spark, sf_dir))
    out = periodic_runs.periodic_runs(docs, min_words=12)
    first = F.expr("array_min(transform(runs, r -> struct(-r.length as length, r.start as start, r.period as period)))")
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return (out.withColumn("first", first)
            .select(F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), "first.start",
                    (-F.col("first.length")).alias("length"), "first.period",
                    F.floor(-1000 * F.col("first.length") / F.col("first.period")).alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.fill_middle(_texts(spark, sf_dir))
    return fill_middle.restore_texts(cut).select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_mixing": op2_mixing,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_token_files": op5_token_files,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_token_counts": op8_token_counts,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_toxicity": op10_toxicity,
    "op11_language_model": op11_language_model,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fill_middle": op13_fill_middle,
}
