"""Corpus pipeline: from documents to packed training sequences.

``STAGES`` are applied in order; each gets what its predecessor kept, written as
Parquet and read again, and all but the last return the columns of documents:

1. toxicity: documents that the classifier rejects go.
2. line dedup: lines that ten documents or more hold go (texts change, no row goes).
3. SimHash near-dedup: one document of each linked group stays.
4. mixing: documents repeat until the expected token shares of clean and low
   quality text meet their targets. The budget is the least at which no domain
   has to shrink, and no rate is below one, so no document goes here.
5. best-fit packing: the pieces of all documents in sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import line_dedup, mixing, packing, simhash, toxicity
from tidewater.llm.common import column, materialise, read_table

TOXIC_SCORE = 0.3
LINE_DOCS = 10
SHINGLE_WORDS, MAX_BITS = 4, 4
TARGETS = {"clean": 0.85, "low": 0.15}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.drop_toxic(docs, model, threshold=TOXIC_SCORE)


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs, min_docs=LINE_DOCS)
    out = out.select(*[column(out, c) for c in docs.columns])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=SHINGLE_WORDS, reach=MAX_BITS)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = mixing.label_domains(read_table(spark, sf_dir, "labels"))
    return mixing.take_copies(docs, labels, TARGETS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_frequent_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("mixing", mix_to_targets),
    ("best_fit_packing", pack_sequences),
]

#: Tokens, fingerprint groups and fitted models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
