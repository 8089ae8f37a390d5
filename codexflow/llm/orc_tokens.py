"""Token ids in ORC: sorted stripes with run-length encoded integers, row indexes and Bloom filters.

Documents are dealt by ranges of their ids and sorted, each task encodes its texts and writes one
file, so ids ascend within a file and from file to file. ORC keeps the integers run-length encoded
and, for every ``ROW_STRIDE`` rows of a stripe, the least and greatest document id and a Bloom
filter over the ids: readers take stripes in parallel and skip those that can't hold what is asked.

A tokenizer that drops white space and lets no token cross it encodes the chunks between white space
one by one, so each distinct chunk of a run of texts is encoded once and the texts' ids are gathered by
numpy. A chunk of Latin letters with marks behind them comes apart into these two, and a worker
remembers the ids of what it has met. Whether the tokenizer's file allows all that is read from the
file; other tokenizers encode whole texts.

Defined results: a null or empty text has the end id alone; strings of special tokens within a text
count as the library counts them; rows with a null id come first; rows that repeat an id follow each
other in any order; empty tables give empty files; other columns aren't written.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexflow.llm.common import runs, shared_dir, stored, worker_state

ROW_STRIDE, STRIPE_BYTES, BLOOM_FPP = 1000, 32 << 20, 0.01
#: Text bytes whose chunks are encoded together, and units that a worker remembers at most.
TEXT_RUN, CACHE_UNITS = 16 << 20, 1_500_000
#: Files are numbered in groups of so many, for the sums of ids before them.
FILE_GROUP = 1024
_LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_SEPARATOR = "\x01"
#: Fixed: the pattern of pieces by which letters, and marks behind them, are pieces of their own.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def allows_chunks(config: dict) -> bool:
    """Whether a tokenizer's file says that texts may be cut at white space and behind letters: it drops
    white space, lower-cases, cuts by ``_PIECES``, and its added tokens neither hold nor take white space."""
    norm, pre = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
    kinds = [(n["type"], n.get("pattern")) for n in norm.get("normalizers", [])]
    cutter = (pre.get("pretokenizers") or [{}])[0]
    return (
        kinds == [("NFC", None), ("Replace", {"Regex": "\\s+"}), ("Lowercase", None)]
        and cutter == {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True}
        and [p.get("use_regex") for p in pre["pretokenizers"][1:]] == [False]
        and config["model"].get("end_of_word_suffix") == "</w>"
        and not config.get("post_processor")
        and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or any(c.isspace() or c == _SEPARATOR for c in a["content"]) for a in config["added_tokens"])
    )


def _gather(values: np.ndarray, ends: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joined values of the groups ``take``, and the size of each; group i ends at ``ends[i]``."""
    begins = np.append(0, ends[:-1])
    size = (ends - begins)[take]
    stop = np.cumsum(size)
    return values[np.repeat(begins[take] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)], size


class ChunkEncoder:
    """Ids of texts by way of the distinct chunks between white space."""

    def __init__(self, tokenizer_file: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as file:
            self.chunked = allows_chunks(json.load(file))
        if self.chunked:
            self.separator = self._ids(_SEPARATOR)
            self.chunked = len(self.separator) == 1
            self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.tokenizer.get_vocab_size())])
        self._forget()

    def _forget(self) -> None:
        # The first unit is the empty one, without ids.
        self.units, self.values, self.ends = pa.array([""]), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, the end id behind each, and the number of ids of each."""
        if not self.chunked:
            found = [np.append(self._ids(t), np.int32(end)) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(x) for x in found], np.int64)
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        units, cuts = self._units(coded.dictionary)
        values, ends = self._learned(units, cuts)
        ids, size = _gather(values, ends, coded.indices.to_numpy())
        before = np.append(0, np.cumsum(size))
        bound = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        count = np.diff(before[bound]) + 1
        out = np.full(int(count.sum()), end, np.int32)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(count) - 1] = False
        out[inside] = ids
        return out, count

    def _units(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Two units a chunk, and which chunks are letters and marks: these in lower case, and the marks;
        any other is one unit as it stands, beside an empty one."""
        core, marks = pc.utf8_rtrim(chunks, _MARKS), pc.utf8_ltrim(chunks, _LETTERS)
        plain = pc.equal(pc.add(pc.binary_length(core), pc.binary_length(marks)), pc.binary_length(chunks))
        first = pc.if_else(plain, pc.utf8_lower(core), chunks)
        return pa.concat_arrays([first, pc.if_else(plain, marks, "")]), plain.to_numpy(zero_copy_only=False)

    def _learned(self, units: pa.Array, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every chunk, joined, and where they end."""
        coded = units.dictionary_encode()
        if len(self.units) + len(coded.dictionary) > CACHE_UNITS:
            self._forget()
        place = pc.index_in(coded.dictionary, self.units)
        if place.null_count:
            single = np.zeros(len(coded.dictionary), bool)  # letters or marks alone make one piece
            both = coded.indices.to_numpy()
            single[both[: len(plain)][plain]] = True
            single[both[len(plain) :]] = True
            new = pc.is_null(place).to_numpy(zero_copy_only=False)
            for kind, wanted in ((self._pieces, new & single), (self._chunks, new & ~single)):
                rows = coded.dictionary.filter(pa.array(wanted))
                for at in range(0, len(rows), 8192):
                    self._add(rows.slice(at, 8192), *kind(rows.slice(at, 8192).to_pylist()))
            place = pc.index_in(coded.dictionary, self.units)
        both = place.to_numpy()[coded.indices.to_numpy()]
        half = len(plain)
        values, size = _gather(self.values, self.ends, both.reshape(2, half).T.ravel())
        return values, np.cumsum(size)[1::2]

    def _add(self, units: pa.Array, ids: np.ndarray, size: np.ndarray) -> None:
        self.units = pa.concat_arrays([self.units, units])
        self.ends = np.append(self.ends, len(self.values) + np.cumsum(size))
        self.values = np.append(self.values, ids)

    def _pieces(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of one piece: where a piece ends, an id ends a word."""
        ids = self._ids(" ".join(units))
        stops = np.flatnonzero(self.last[ids]) + 1
        return (ids, np.diff(stops, prepend=0)) if len(stops) == len(units) else self._one_by_one(units)

    def _chunks(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of any number of pieces: a separator of one id stands between them."""
        if any(_SEPARATOR in u for u in units):
            return self._one_by_one(units)
        ids = self._ids(f" {_SEPARATOR} ".join(units))
        between = ids == self.separator[0]
        stops = np.append(np.flatnonzero(between), len(ids))
        if len(stops) != len(units):
            return self._one_by_one(units)
        return ids[~between], np.diff(stops, prepend=-1) - 1

    def _one_by_one(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        size = np.array([len(x) for x in found], np.int64)
        return np.fromiter((i for x in found for i in x), np.int32, int(size.sum())), size


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``doc_id``, ``place`` (row number among those of its task) and ``ids`` below ``path``."""

    def work(batches):
        coder = worker_state(f"orc:{tokenizer_file}", lambda: ChunkEncoder(tokenizer_file))
        place = 0
        for whole in batches:
            for batch in runs(whole, "text_", TEXT_RUN):
                ids, count = coder.encode(batch.column("text_").cast(pa.string()), end_id)
                offsets = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
                places = pa.array(np.arange(place, place + len(count)), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), places, pa.ListArray.from_arrays(offsets, pa.array(ids))], names=["doc_id", "place", "ids"])
                place += len(count)

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text_"))
    sorted_ = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    coded = sorted_.mapInArrow(work, f"doc_id {docs.schema[id_col].dataType.simpleString()}, place long, ids array<int>")
    options = {
        "orc.create.index": "true", "orc.row.index.stride": str(ROW_STRIDE), "orc.stripe.size": str(STRIPE_BYTES),
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(BLOOM_FPP), "compression": "zstd",
    }
    coded.write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``place``, ``ids`` and ``file``; a filter on ``doc_id`` reaches the stripes' indexes."""
    return spark.read.orc(path).select("doc_id", "place", "ids", F.col("_metadata.file_name").alias("file"))


def token_index(tokens: DataFrame) -> DataFrame:
    """Of each document in files that were read: ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32`` of the ids as little-endian unsigned 32-bit integers."""

    def work(batches):
        for batch in batches:
            lists = batch.column("ids")
            at = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            kept = [batch.column(c) for c in ("doc_id", "place", "file")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "place", "file", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    rows = tokens.select("doc_id", "place", "file", "ids").mapInArrow(work, f"doc_id {kind}, place long, file string, n_tokens long, ids_crc32 long")
    rows = stored(rows, "token-index")  # a few numbers a document, so the files are read once
    inside = rows.withColumn("before", F.expr("sum(n_tokens) over (partition by file order by place) - n_tokens"))
    # One row a file. Files are numbered in the order of their ids, and those of one task, if it writes several, by
    # their first places; sums run inside groups of files, and over groups, of which there is one for FILE_GROUP tasks.
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("place").alias("first")).withColumn("number", number).withColumn("group", F.expr(f"number div {FILE_GROUP}"))
    groups = files.groupBy("group").agg(F.sum("n").alias("all")).select("group", F.expr("sum(all) over (order by group) - all").alias("earlier"))
    files = files.join(groups, "group").select("file", F.expr("earlier + sum(n) over (partition by group order by number, first rows unbounded preceding) - n").alias("base"))
    return inside.join(files, "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents' ids into shared storage and index what is read back."""
    path = shared_dir(docs.sparkSession, "token-orc")
    write_tokens(docs, path, tokenizer_file, end_id, id_col, text_col)
    return token_index(read_tokens(docs.sparkSession, path))
