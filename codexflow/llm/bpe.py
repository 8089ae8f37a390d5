"""Byte-level BPE encoding and decoding over length-bucketed, padded numpy matrices.

A text is cut into pieces by the tokenizer's pattern. The distinct pieces that a worker has not
met before become rows of padded matrices, one matrix for each length bucket. In every round each
row merges its leftmost pair of minimum rank; pair ranks come from an open-addressing hash table
held in two arrays, and the merged rows are compacted to the left. Rows without a mergeable pair
leave the matrix. Pieces longer than the widest bucket (a run of letters of several kilobytes) take
the same merges through a heap, so no text is cut and none is slow.

Defined results: a null or empty text has no ids (count 0, decoded to no bytes); repeated rows each
get their own result; other columns of the input are neither read nor returned.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import RUN_BYTES, runs, worker_state

#: Widths of the matrices; longer pieces take the heap.
BUCKETS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 256, 512, 1024)
#: Pieces that a worker remembers; beyond this the memory starts anew.
CACHE_PIECES = 300_000
_NONE = np.int32(2**31 - 1)
_SHIFT = np.uint64(44)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of their merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        size = 1 << (64 - int(_SHIFT))
        if 2 * len(left) > size:
            raise ValueError(f"{len(left)} pairs don't fit a table of {size} places")
        self.mask = size - 1
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, _NONE, np.int32)
        keys = left.astype(np.int64) << 20 | right
        at = self._place(keys)
        waiting = np.arange(len(keys))
        self.probes = 0
        while len(waiting):
            self.probes += 1
            free = waiting[self.keys[at[waiting]] < 0]
            places, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[places] = keys[placed]
            self.values[places] = merged[placed]
            waiting = waiting[self.keys[at[waiting]] != keys[waiting]]
            at[waiting] = (at[waiting] + 1) & self.mask

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _FACTOR >> _SHIFT).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, or the largest int32. Negative ids (padding) have no merge."""
        keys = left.astype(np.int64) << 20 | right
        at = self._place(keys)
        found = np.where(self.keys[at] == keys, self.values[at], _NONE)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0) & (left >= 0) & (right >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            held = self.keys[at[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return np.where((left >= 0) & (right >= 0), found, _NONE)


class ByteBpe:
    """Encoder and decoder for one rank file and one splitting pattern."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        self.token = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.token[rank] = token
        self.decimal = [str(i).encode() for i in range(len(self.token))]
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = array("i")  # as plain numbers: a worker would keep the memory of a tuple for each
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                if (a := self.ranks.get(token[:cut])) is not None and (b := self.ranks.get(token[cut:])) is not None:
                    pairs.extend((a, b, rank))
        self.pairs = PairTable(*np.array(pairs, np.int32).reshape(-1, 3).T)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, int32."""
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        cut = [self.pattern.findall(x) for x in texts]
        new = list(set().union(*cut).difference(self.known))
        self.known.update(zip(new, self._merge(new)))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, pieces)), np.int32) for pieces in cut]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        token = self.token.__getitem__
        return [b"".join(map(token, row.tolist())) for row in ids]

    def _merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as the bytes of an int32 array."""
        out: list[bytes] = [b""] * len(pieces)
        open_: list[tuple[int, bytes]] = []
        for i, piece in enumerate(pieces):
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(raw) > BUCKETS[-1]:
                out[i] = self._merge_by_heap(raw)
            else:
                open_.append((i, raw))
        open_.sort(key=lambda x: len(x[1]))
        lengths = np.array([len(raw) for _, raw in open_], np.int64)
        start = 0
        for width in BUCKETS:
            stop = int(np.searchsorted(lengths, width, "right"))
            step = max(1, (1 << 21) // width)
            for at in range(start, stop, step):
                part = open_[at : min(stop, at + step)]
                for (i, _), ids in zip(part, self._merge_matrix([raw for _, raw in part], width)):
                    out[i] = ids
            start = stop
        return out

    def _merge_matrix(self, rows: list[bytes], width: int) -> Iterator[bytes]:
        count = len(rows)
        length = np.array([len(x) for x in rows], np.int64)
        filled = np.arange(width) < length[:, None]
        ids = np.full((count, width), -1, np.int32)
        ids[filled] = self.of_byte[np.frombuffer(b"".join(rows), np.uint8)]
        done: list[bytes] = [b""] * count
        row = np.arange(count)  # the row of the input that each row of the matrix stands for
        rank = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(count, width - 1)
        columns = np.arange(width)
        while len(row):
            at = rank.argmin(1)  # the leftmost of equals
            each = np.arange(len(row))
            best = rank[each, at]
            over = best == _NONE
            if over.any():
                for i in np.flatnonzero(over):
                    done[row[i]] = ids[i, : length[i]].tobytes()
                live = ~over
                ids, rank, length, row, at, best = ids[live], rank[live], length[live], row[live], at[live], best[live]
                each = np.arange(len(row))
                if not len(row):
                    break
            ids[each, at] = best
            kept = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, kept, 1)
            length = length - 1
            ids[each, length] = -1
            kept = np.minimum(columns[:-1] + (columns[:-1] >= at[:, None]), width - 2)
            rank = np.take_along_axis(rank, kept, 1)
            rank[:, -1] = _NONE
            after = at < width - 1
            rank[each[after], at[after]] = self.pairs.find(ids[each[after], at[after]], ids[each[after], at[after] + 1])
            before = at > 0
            rank[each[before], at[before] - 1] = self.pairs.find(ids[each[before], at[before] - 1], ids[each[before], at[before]])
        return iter(done)

    def _merge_by_heap(self, raw: bytes) -> bytes:
        """The same merges for one long piece: the leftmost pair of minimum rank first."""
        token = [raw[i : i + 1] for i in range(len(raw))]
        ahead = list(range(1, len(raw))) + [-1]
        back = list(range(-1, len(raw) - 1))
        heap = [(r, i, 2) for i in range(len(raw) - 1) if (r := self.ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = ahead[i] if token[i] else -1
            if j < 0 or len(token[i]) + len(token[j]) != size:
                continue  # one of the two has merged meanwhile
            token[i] += token[j]
            token[j] = b""
            ahead[i] = ahead[j]
            if ahead[j] >= 0:
                back[ahead[j]] = i
            for a, b in ((back[i], i), (i, ahead[i])):
                if a >= 0 and b >= 0 and (r := self.ranks.get(token[a] + token[b])) is not None:
                    heapq.heappush(heap, (r, a, len(token[a]) + len(token[b])))
        return np.array([self.ranks[x] for x in token if x], np.int32).tobytes()


def codec(rank_file: str, pattern: str) -> ByteBpe:
    """The worker's codec for this rank file, built once."""
    return worker_state(f"bpe:{rank_file}:{pattern}", lambda: ByteBpe(rank_file, pattern))


def _encoded(batches: Iterable[pa.RecordBatch], bpe: ByteBpe, id_col: str) -> Iterator[pa.RecordBatch]:
    """Rows of ``encode_documents``, for a run of texts at a time: a piece takes some ten times its bytes here."""
    for whole in batches:
        for batch in runs(whole, "text_", RUN_BYTES // 4):
            ids = bpe.encode(batch.column("text_").to_pylist())
            decimal = bpe.decimal.__getitem__
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array([hashlib.sha256(b" ".join(map(decimal, x.tolist()))).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x).hexdigest() for row in ids for x in bpe.decode([row])]),
                ],
                names=[id_col, "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts and decode the ids again.

    Returns the id column, ``token_ids`` array<int>, ``n_tokens`` long, ``ids_sha256`` (of the decimal
    ids joined by one space) and ``decoded_sha256`` (of the bytes that the ids decode to).
    """
    narrow = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text_"))
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, token_ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"

    return narrow.mapInArrow(lambda batches: _encoded(batches, codec(rank_file, pattern), id_col), schema)


def decode_documents(tokens: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Decode ``ids_col``; returns the id column and ``content`` binary. Null ids decode to no bytes."""
    schema = f"`{id_col}` {tokens.schema[id_col].dataType.simpleString()}, content binary"

    def decode(batches):
        bpe = codec(rank_file, pattern)
        for batch in batches:
            rows = [np.array(x or [], np.int32) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(bpe.decode(rows), pa.binary())], names=[id_col, "content"])

    return tokens.select(id_col, ids_col).mapInArrow(decode, schema)
