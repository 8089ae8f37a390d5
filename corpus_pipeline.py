"""The training-data pipeline: stages of the corpus operators, each written and read again.

Defined results, of every stage: a null or empty text is neither toxic nor a repeat nor contaminated and has no
ids, but documents without any word are near copies of each other like any equal texts are; of equal ids or
texts the smallest id stays, rows that repeat an id are one document; an empty table stays empty; other columns pass
through unchanged but for ``n_chars``, which follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexflow.llm import bpe, cdc, decontam, nearcopies, toxicity
from codexflow.llm.common import stored


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5, by a model of the labelled ones among ``docs``."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word similarity 0.8 and more) the document of the smallest id."""
    return nearcopies.drop_near_copies(docs, shingle=5, similarity=0.8)


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in one of a smaller id; ``n_chars`` follows the text."""
    kept = cdc.deduplicate(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast(kept.schema["n_chars"].dataType), F.col("n_chars"))).select(*docs.columns)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's whole text, with digests of the ids and of what they decode to."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxic_out),
    ("simhash", near_copies_out),
    ("substring_dedup", repeats_out),
    ("decontamination", benchmark_out),
    ("byte_bpe", encode_bytes),
]

#: Compression lengths, gear hashes and BPE merges have no SQL form. The tests hold BPE, decontamination and near copies
#: against brute force, toxicity and chunks against planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage but the last is stored as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
