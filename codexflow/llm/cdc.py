"""Substring deduplication by content-defined chunking with a gear rolling hash.

Texts are cut where the gear hash of the last sixteen bytes is low, so the places of cuts depend on
nothing but the bytes just before them, and text that an insertion has shifted is cut like before.
A cut that follows another within ``LEAST`` bytes is left out, stretches over ``MOST`` bytes are cut
at fixed lengths, and no character is cut in two. Every chunk is keyed by a 128-bit digest. A chunk
repeats if a document of a smaller id has one of the same digest; runs of such chunks of
``RUN`` bytes and more are removed, so a passage stays in the document of the smallest id alone.

The smallest id of each digest is found by an aggregation, which combines before it shuffles. Those of digests that
repeat are stored, and the join that brings them back to the chunks has one row for a digest on that side, so
Spark's skew handling splits the chunks of a digest that much of the corpus shares. Nothing pairs documents with each other.

Defined results: null texts stay null and count as empty; documents of a null id keep their text and
take none from others; rows that repeat an id belong to one document and don't repeat each other;
empty tables give no rows. ``deduplicate`` keeps all columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import free_name, runs, stored, text_bytes

LEAST, SPREAD, MOST = 16, 16, 128
#: Bytes of a run of repeated chunks from which on it is removed.
RUN = 64
_GEAR = np.random.default_rng(2024).integers(0, 1 << 16, 256, dtype=np.uint16)


def chunks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where chunks begin in ``data``, the joined bytes of texts that lie at ``starts`` to ``ends``."""
    gear = _GEAR[data]
    for n in (1, 2, 4, 8):
        shifted = gear.copy()
        shifted[n:] += gear[:-n] << np.uint16(n)
        gear = shifted
    whole = np.append((data & 0xC0) != 0x80, True)  # a character begins, or the data end
    cut = np.flatnonzero(gear < (1 << 16) // SPREAD) + 1
    text = np.searchsorted(ends, cut, "left").clip(max=max(0, len(ends) - 1))
    cut = cut[(cut - starts[text] >= LEAST) & (ends[text] - cut >= LEAST) & whole[cut]] if len(ends) else cut[:0]
    full = starts[ends > starts]
    cut = np.union1d(cut, full)
    first = np.isin(cut, full)
    cut = cut[first | (np.diff(cut, prepend=-LEAST) >= LEAST)]
    stop = np.append(cut[1:], len(data)) if len(cut) else cut
    extra = np.maximum(0, (stop - cut - 1) // MOST)
    more = np.repeat(cut, extra) + MOST * (np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1)
    for _ in range(3):
        more = np.where(whole[more], more, more + 1)
    return np.union1d(cut, more)


def _cut(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Joined bytes, and of every chunk its text, begin (in the text) and size."""
    joined = b"".join(texts)
    ends = np.cumsum([len(x) for x in texts], dtype=np.int64)
    starts = ends - [len(x) for x in texts]
    begin = chunks(np.frombuffer(joined, np.uint8), starts, ends)
    size = np.diff(np.append(begin, len(joined)))
    text = np.searchsorted(starts, begin, "right") - 1
    return joined, text, begin - starts[text] if len(begin) else begin, size


def _digests(joined: bytes, size: np.ndarray) -> np.ndarray:
    digest, view = xxhash.xxh3_128_digest, memoryview(joined)
    ends = np.cumsum(size).tolist()
    return np.frombuffer(b"".join([digest(view[a:b]) for a, b in zip([0, *ends], ends)]), np.int64).reshape(-1, 2)


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every chunk: ``id``, ``text_key`` (hash of the whole text), ``begin``, ``size``, digest ``d1``, ``d2``."""

    def work(batches):
        for whole in batches:
            for batch in runs(whole, "text_"):
                joined, text, begin, size = _cut(text_bytes(batch.column("text_")))
                digest = _digests(joined, size)
                taken = pa.array(text)
                columns = [batch.column("id").take(taken), batch.column("text_key").take(taken)]
                columns += [pa.array(begin.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "text_key", "begin", "size", "d1", "d2"])

    narrow = docs.filter(F.col(id_col).isNotNull() & (F.octet_length(text_col) >= RUN))
    narrow = narrow.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text_"))
    return narrow.mapInArrow(work, f"id {docs.schema[id_col].dataType.simpleString()}, text_key long, begin int, size int, d1 long, d2 long")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text_key`` and ``spans`` (begin, stop in bytes, sorted): the runs to remove, of texts that have one."""
    pieces = chunk_documents(docs, id_col, text_col)
    known = pieces.groupBy("d1", "d2").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").drop("most")
    known = stored(known, "repeated")
    again = pieces.join(known, ["d1", "d2"]).filter("id > least")
    listed = again.groupBy("id", "text_key").agg(F.array_sort(F.collect_set(F.struct("begin", (F.col("begin") + F.col("size")).alias("stop")))).alias("parts"))
    empty = F.array().cast("array<struct<begin:int,stop:int>>")
    merged = F.aggregate(
        "parts",
        empty,
        lambda a, p: F.when((F.size(a) > 0) & (F.element_at(a, -1).stop == p.begin), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1).begin.alias("begin"), p.stop.alias("stop"))))).otherwise(F.concat(a, F.array(p))),
    )
    return listed.select("id", "text_key", F.filter(merged, lambda s: s.stop - s.begin >= RUN).alias("spans")).filter(F.size("spans") > 0)


def _with_spans(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with one more column, the spans to remove (null: none)."""
    key, text_key, spans = (free_name(docs, x) for x in ("span_id", "span_text", "spans"))
    found = repeated_spans(docs, id_col, text_col).select(F.col("id").alias(key), F.col("text_key").alias(text_key), F.col("spans").alias(spans))
    joined = docs.join(found, (docs[id_col] == found[key]) & (F.xxhash64(docs[text_col]) == found[text_key]), "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], spans), spans


def _kept(text: bytes, spans: list[dict] | None) -> bytes:
    if not spans:
        return text
    at, out = 0, []
    for span in spans:
        out.append(text[at : span["begin"]])
        at = span["stop"]
    return b"".join([*out, text[at:]])


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of what stays."""

    def work(batches):
        for batch in batches:
            texts, spans = text_bytes(batch.column("text_")), batch.column("spans").to_pylist()
            kept = [_kept(t, s) for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
                    pa.array([len(s or ()) for s in spans], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    joined, spans = _with_spans(docs.select(F.col(id_col), F.col(text_col).alias("text_")), id_col, "text_")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.withColumnRenamed(spans, "spans").mapInArrow(work, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated runs cut out of their texts; all columns stay."""
    joined, spans = _with_spans(docs, id_col, text_col)
    at, cut = docs.columns.index(text_col), len(docs.columns)

    def work(batches):
        for batch in batches:
            kept = [None if t is None else _kept(t.encode(), s).decode() for t, s in zip(batch.column(at).to_pylist(), batch.column(cut).to_pylist())]
            columns = batch.columns[:cut]
            columns[at] = pa.array(kept, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:cut])

    return joined.mapInArrow(work, docs.schema)
