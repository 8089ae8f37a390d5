"""The chunk encoder against the library's own call, and what the ORC files hold."""

import glob
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from codexflow.llm import orc_tokens

WORDS, BYTES = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = "a|B|é|É|ß|µ|ª|'s|'T|'|...|,|!|<|endoftext|>|1|23|\u0301| |\x85|\x1c|\x01|  |\n|\t|Σ|ΟΔΟΣ|日本|😀|\u200d|İ|ﬁ|Hello|\r\n|\u3000|Å|×|_|\u1100|\u1161".split("|")


@pytest.mark.parametrize("file, chunked", [(WORDS, True), (BYTES, False)])
def test_encoder_equals_the_library(file, chunked):
    rng, library = random.Random(5), Tokenizer.from_file(file)
    parts = [*ODD, "<|endoftext|>", "<|startoftext|>", "<|"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)] + ["", " ", "x" * 100_000, "word. " * 50_000]
    coder = orc_tokens.ChunkEncoder(file)
    assert coder.chunked is chunked
    for _ in range(2):  # the second time all units are known
        ids, count = coder.encode(pa.array(texts), 2)
        for text, own in zip(texts, np.split(ids, np.cumsum(count)[:-1])):
            assert own.tolist() == library.encode(text, add_special_tokens=False).ids + [2]


def test_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(orc_tokens, "CACHE_UNITS", 50)
    coder, library = orc_tokens.ChunkEncoder(WORDS), Tokenizer.from_file(WORDS)
    for k in range(5):
        text = " ".join(f"word{chr(97 + k)}{chr(97 + i)}" for i in range(26))
        assert coder.encode(pa.array([text]), 2)[0].tolist() == library.encode(text, add_special_tokens=False).ids + [2]


def test_files_hold_indexes_filters_and_runs(spark, tmp_path):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    path = str(tmp_path / "orc")
    orc_tokens.write_tokens(docs, path, WORDS, 2)
    jvm, kinds, streams = spark._jvm, set(), set()
    orc = jvm.org.apache.orc.OrcFile
    for name in glob.glob(f"{path}/*.orc"):
        reader = orc.createReader(jvm.org.apache.hadoop.fs.Path(name), orc.readerOptions(spark._jsc.hadoopConfiguration()))
        assert reader.getRowIndexStride() == orc_tokens.ROW_STRIDE
        rows = reader.rows()
        for stripe in reader.getStripes():
            footer = rows.readStripeFooter(stripe)
            kinds |= {footer.getColumns(k).getKind().toString() for k in (1, 2, 4)}  # doc_id, place, the ids
            streams |= {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
    assert kinds == {"DIRECT_V2"}  # the second version of integer run lengths
    assert {(1, "ROW_INDEX"), (1, "BLOOM_FILTER_UTF8")} <= streams and (4, "BLOOM_FILTER_UTF8") not in streams


def test_starts_follow_file_numbers(spark, monkeypatch):
    monkeypatch.setattr(orc_tokens, "FILE_GROUP", 2)
    names = {99_999: 0, 100_000: 1, 100_001: 2, 100_002: 3}
    rows = [(10 * k + i, i, [7] * (k + i), f"part-{n}-x.orc") for n, k in names.items() for i in range(3)]
    tokens = spark.createDataFrame(rows, "doc_id long, place long, ids array<int>, file string")
    at = 0
    for r in sorted(orc_tokens.token_index(tokens).collect(), key=lambda r: r["doc_id"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_starts_when_a_task_writes_many_files(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        found = orc_tokens.round_trip(docs, WORDS, 2).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    at = 0
    for r in sorted(found, key=lambda r: r["doc_id"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert len(found) == docs.count()
