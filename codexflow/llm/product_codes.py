"""Vector codes by product quantisation in exact integers.

Components become integers, floor(``SCALE`` x); a vector is cut into ``PARTS`` equal parts, each with a codebook of at
most ``ENTRIES`` entries. A round sends the codebooks (bounded: entries times the vector's length) to the tasks;
Arrow batches get all squared distances by |x|^2 - 2 x c + |c|^2 with int64 matrix products and take the first
least. Every task adds its parts up by entry, so at most parts times entries rows leave it; a grouped shuffle
adds those, and the same number of rows comes to the driver, which divides.

Defined results: rows whose vector is null or holds a null or a component that isn't finite go; an empty vector
is a vector; vectors shorter than the longest kept one are filled with zeros, as is the longest up to a multiple of
``PARTS``; integers are held within +-2^30, and closer where longer vectors' distances would not fit 64 bits;
rows that repeat an id get a row each, and of equal ids at the start the lesser vector comes first, null ids
last; an entry without parts stays as it is; fewer rows than ``ENTRIES`` give as many entries; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Rows of a batch that are compared with the codebooks at once.
RUN_ROWS = 8192


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id_``, ``label_`` and ``ints`` of the rows that are kept."""

    def work(batches):
        for batch in batches:
            lists = batch.column("vector_")
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            at = lists.offsets.to_numpy().astype(np.int64)
            bad = ~np.isfinite(values)
            before = np.concatenate([[0], np.cumsum(bad)])
            keep = lists.is_valid().to_numpy(zero_copy_only=False) & (before[at[1:]] == before[at[:-1]])
            with np.errstate(over="ignore"):
                ints = np.clip(np.floor(np.where(bad, 0.0, values) * SCALE), -(1 << 30), 1 << 30).astype(np.int32)
            whole = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ints))
            out = pa.RecordBatch.from_arrays([batch.column("id_"), batch.column("label_"), whole], names=["id_", "label_", "ints"])
            yield out.filter(pa.array(keep))

    kinds = [df.schema[c].dataType.simpleString() for c in (id_col, label_col)]
    narrow = df.select(F.col(id_col).alias("id_"), F.col(label_col).alias("label_"), F.col(vector_col).alias("vector_"))
    return narrow.mapInArrow(work, f"id_ {kinds[0]}, label_ {kinds[1]}, ints array<int>")


def _matrix(lists: pa.ListArray, length: int, limit: int) -> np.ndarray:
    """int64 rows of ``length`` components; shorter lists are filled with zeros."""
    at = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]].astype(np.int64)
    sizes = np.diff(at)
    out = np.zeros((len(sizes), length), np.int64)
    out[np.arange(length) < sizes[:, None]] = values
    return np.clip(out, -limit, limit)


def _nearest(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First nearest entry and squared distance of ``parts`` (rows, parts, width) in ``books`` (parts, entries, width)."""
    products = np.matmul(parts.transpose(1, 0, 2), books.transpose(0, 2, 1))  # parts, rows, entries
    far = (parts**2).sum(2).T[:, :, None] - 2 * products + (books**2).sum(2)[:, None, :]
    nearest = far.argmin(2)
    return nearest.T, np.take_along_axis(far, nearest[:, :, None], 2)[:, :, 0].T


class Shape:
    """Length, width of a part and the bound of components, by the longest vector."""

    def __init__(self, longest: int):
        self.width = -(-longest // PARTS)
        self.length = self.width * PARTS
        self.limit = min(1 << 30, isqrt((1 << 62) // max(self.length, 1)) // 2)


def _runs(batches, shape: Shape):
    for batch in batches:
        for at in range(0, batch.num_rows, RUN_ROWS):
            run = batch.slice(at, RUN_ROWS)
            yield run, _matrix(run.column("ints"), shape.length, shape.limit).reshape(run.num_rows, PARTS, shape.width)


def _summed(vectors: DataFrame, shape: Shape, books: np.ndarray) -> dict[tuple[int, int], list[int]]:
    """Count and component sums of the parts of every used entry."""
    entries, width = books.shape[1], shape.width

    def work(batches):
        total = np.zeros((PARTS, entries, 1 + width), np.int64)
        for _, parts in _runs(batches, shape):
            nearest, _ = _nearest(parts, books)
            for p in range(PARTS):
                total[p, :, 0] += np.bincount(nearest[:, p], minlength=entries)
                np.add.at(total[p, :, 1:], nearest[:, p], parts[:, p])
        part, entry = np.nonzero(total[:, :, 0])
        rows = total[part, entry]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(rows.tolist(), pa.list_(pa.int64()))], names=["part", "entry", "sums"])

    sums = vectors.select("ints").mapInArrow(work, "part long, entry long, sums array<long>")
    merged = sums.groupBy("part", "entry").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(1 + width)]).alias("sums"))
    return {(r["part"], r["entry"]): r["sums"] for r in merged.collect()}  # PARTS * ENTRIES rows at most


def train(vectors: DataFrame, shape: Shape) -> np.ndarray:
    """Codebooks (parts, entries, width) after ``ROUNDS`` rounds over ``integer_vectors``."""
    first = vectors.orderBy(F.col("id_").asc_nulls_last(), "ints").limit(ENTRIES).select("ints").collect()
    start = np.zeros((len(first), shape.length), np.int64)
    for row, found in zip(start, first):
        row[: len(found["ints"])] = found["ints"]
    books = np.clip(start, -shape.limit, shape.limit).reshape(len(first), PARTS, shape.width).transpose(1, 0, 2).copy()
    for _ in range(ROUNDS):
        for (part, entry), (count, *sums) in _summed(vectors, shape, books).items():
            books[part, entry] = [s // count for s in sums]
    return books


def encode(vectors: DataFrame, shape: Shape, books: np.ndarray) -> DataFrame:
    """``id_``, ``label_``, ``code`` (an entry a part) and ``error`` (squared distance over all parts) of each row."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in ("id_", "label_")]

    def work(batches):
        for run, parts in _runs(batches, shape):
            nearest, error = _nearest(parts, books)
            codes = pa.array([bytes(r) for r in nearest.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([run.column("id_"), run.column("label_"), codes, pa.array(error.sum(1))], names=["id_", "label_", "code", "error"])

    return vectors.mapInArrow(work, f"id_ {kinds[0]}, label_ {kinds[1]}, code binary, error long")


def decode(codes: list[bytes], books: np.ndarray) -> np.ndarray:
    """The integer vectors that codes stand for."""
    at = np.array([list(c) for c in codes], np.int64).reshape(-1, PARTS)
    return books[np.arange(PARTS), at].reshape(len(codes), -1)


def quantise(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per kept row: the id, ``code`` (binary), ``error``, ``label_error`` (errors summed over equal labels) and
    ``codebooks``, the decimal integers of all entries by part, entry and place."""
    vectors = stored(integer_vectors(df, id_col, vector_col, label_col), "vectors")
    longest = vectors.agg(F.max(F.size("ints"))).first()[0]
    shape = Shape(longest or 0)
    books = train(vectors, shape) if longest is not None else np.zeros((PARTS, 0, 0), np.int64)
    coded = stored(encode(vectors, shape, books), "codes")
    # Stored, so that a hot label's rows can be split where the sums come back.
    sums = stored(coded.groupBy(F.col("label_").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    joined = coded.join(sums, F.col("label_").eqNullSafe(F.col("of")))
    written = ",".join(map(str, books.reshape(-1).tolist()))
    return joined.select(F.col("id_").alias(id_col), "code", "error", "label_error", F.lit(hashlib.sha256(written.encode()).hexdigest()).alias("codebooks_sha256"))
