"""The numbered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexflow.llm import bpe, cdc, decontam, langid, media, mixing, orc_tokens, product_codes, rindex, simhash, toxicity, turns, warc
from codexflow.llm.oracles import ORACLE_SQL  # noqa: F401  (registered beside the queries)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = _table(spark, sf_dir, "documents")
    return langid.predict_documents(docs, langid.train(docs))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, time-coded pair codes and their digest of every document's audio, read from its stored form."""
    stored = media.encode_media(_table(spark, sf_dir, "documents"))
    return media.fingerprint_media(stored, keep=("n_bytes",))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, as digests, and the digest of what they decode to."""
    docs = _table(spark, sf_dir, "documents")
    coded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op5_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from ORC."""
    return orc_tokens.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and contaminating items of every document, for windows of ten words."""
    hits = decontam.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), width=10)
    return hits.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What content-defined chunking removes from every document."""
    return cdc.removal_report(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id of its component."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3)


def op10_rindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to documents of smaller ids, for strings of 50 bytes."""
    return rindex.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as it is read back from the archives that were written."""
    records = warc.round_trip(_table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation once its rows are damaged."""
    return turns.repair(turns.damage(_table(spark, sf_dir, "conversations")), times_col="times")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every embedding."""
    coded = product_codes.quantise(_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_langid": op1_langid,
    "op2_media": op2_media,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_orc_tokens": op5_orc_tokens,
    "op6_decontamination": op6_decontamination,
    "op7_chunk_dedup": op7_chunk_dedup,
    "op8_simhash": op8_simhash,
    "op9_warc": op9_warc,
    "op10_rindex": op10_rindex,
    "op11_repair": op11_repair,
    "op12_mixing": op12_mixing,
    "op13_codes": op13_codes,
}
