"""SimHash near-duplicates, linked through shards of BK-trees.

Every text gives a 64-bit fingerprint. Distinct fingerprints go to shards: if two differ in at most
three bits, one of their four 16-bit bands is equal, and of four 12-bit parts of the rest one more,
so they share one of sixteen 28-bit keys. A shard is a BK-tree over the fingerprints of a key; its
children are keyed by the integer Hamming distance to their parent, and a search follows only the
edges within the radius. A tree isn't broadcast, since together they grow with the corpus: each is
built and searched in the task to which its key was dealt. A key with many fingerprints is dealt
out in blocks, one for every two of its parts, so no task holds more than two parts of a key and no
pair is lost. Shards return a spanning forest of their links, not all pairs; components follow.

Defined results: null, empty or blank texts have fingerprint zero and are linked like any other;
fewer words than a shingle are one shingle; repeated rows get a row each; null ids take part in
links, but a component's id is its smallest id that isn't null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import RUN_BYTES, free_name, runs, stored, text_bytes
from codexflow.llm.components import connected_components

#: Fingerprints of one key that a shard holds; a larger key becomes blocks of two parts.
SHARD = 2000
#: (query, node) pairs that a search holds at once.
FRONT = 2_000_000


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """uint64 fingerprint of each text: a bit is set if it is set in over half the shingles' hashes."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = ends - [len(w) + 1 for w in words]
        if len(words) > shingle:
            spans = zip(starts[: 1 - shingle].tolist(), (ends[shingle - 1 :] - 1).tolist())
        else:
            spans = [(0, len(joined))]
        before = len(hashes)
        hashes += [digest(joined[a:b], 42) for a, b in spans]
        counts[i] = len(hashes) - before
    return codes_of(np.array(hashes, np.uint64), counts)


def codes_of(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """uint64 fingerprint of each run of ``counts`` hashes; zero of none."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, np.concatenate([[0], np.cumsum(counts[full])[:-1]]), axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * sums > counts[full, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


class BkForest:
    """BK-trees over runs of equal ``group``; the first fingerprint of a run is its root."""

    def __init__(self, group: np.ndarray, code: np.ndarray):
        self.code = code
        n = len(code)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        self.root = np.repeat(first, np.diff(np.r_[first, n]))
        parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        above = self.root.copy()
        waiting = np.flatnonzero(self.root != np.arange(n))
        while len(waiting):
            distance = np.bitwise_count(code[waiting] ^ code[above[waiting]]).astype(np.int64)
            slot = above[waiting] * 65 + distance
            _, place, back = np.unique(slot, return_index=True, return_inverse=True)
            child = waiting[place]  # the first to come to a free edge hangs there
            parent[child], edge[child] = above[child], distance[place]
            above[waiting] = child[back]
            waiting = waiting[above[waiting] != waiting]
        order = np.lexsort((edge, parent))
        self.child, self.edge = order, edge[order]
        self.begin = np.searchsorted(parent[order], np.arange(n), "left")
        self.end = np.searchsorted(parent[order], np.arange(n), "right")

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) of one tree whose codes differ in ``radius`` bits at most."""
        query, node = queries, self.root[queries]
        found = []
        while len(query):
            distance = np.bitwise_count(self.code[query] ^ self.code[node]).astype(np.int64)
            near = distance <= radius
            found.append((query[near], node[near]))
            many = self.end[node] - self.begin[node]
            total = int(many.sum())
            at = np.repeat(self.begin[node] - (np.cumsum(many) - many), many) + np.arange(total)
            follow = np.abs(self.edge[at] - np.repeat(distance, many)) <= radius
            query, node = np.repeat(query, many)[follow], self.child[at[follow]]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (queries, queries)


def link_groups(group: np.ndarray, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (code, code) that join what is within ``radius`` in each group: one link a node at most."""
    forest = BkForest(group, code)
    label = np.arange(len(code))
    size = np.bincount(forest.root, minlength=len(code))[forest.root]
    cuts = np.searchsorted(np.cumsum(size), np.arange(FRONT, int(size.sum()) + FRONT, FRONT))
    at = 0
    for stop in np.append(cuts, len(code)):
        stop = max(int(stop), at + 1)
        a, b = forest.within(np.arange(at, min(stop, len(code))), radius)
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label != label[label]).any():
                label = label[label]
        at = stop
        if at >= len(code):
            break
    moved = np.flatnonzero((label != np.arange(len(code))) & (code != code[label]))
    return code[moved], code[label[moved]]


def _link_batches(batches, radius: int):
    """Links of the groups in a stream sorted by ``shard``; groups may span batches."""
    held_group, held_code = np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)

    def linked(group, code):
        number = np.cumsum(np.r_[False, (group[1:] != group[:-1]).any(1)]) if len(group) else np.zeros(0, np.int64)
        a, b = link_groups(number, code, radius) if len(code) else (code, code)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        group = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("shard", "x", "y")], 1)
        held_group = np.concatenate([held_group, group])
        held_code = np.concatenate([held_code, batch.column("code").to_numpy().view(np.uint64)])
        if len(held_code) < 100_000:
            continue
        ended = np.flatnonzero((held_group != held_group[-1]).any(1))
        cut = int(ended[-1]) + 1 if len(ended) else 0
        if cut:
            yield linked(held_group[:cut], held_code[:cut])
            held_group, held_code = held_group[cut:], held_code[cut:]
    if len(held_code):
        yield linked(held_group, held_code)


def _shards(code: Column) -> Column:
    """The sixteen keys of a fingerprint, each with its own number in front."""
    keys = []
    for band in range(4):
        turned = F.shiftleft(code, 16 * band).bitwiseOR(F.shiftrightunsigned(code, 64 - 16 * band)) if band else code
        for part in range(4):
            top = F.shiftleft(F.shiftrightunsigned(turned, 48), 12)
            low = F.shiftrightunsigned(turned, 36 - 12 * part).bitwiseAND(F.lit(0xFFF))
            keys.append(top.bitwiseOR(low).bitwiseOR(F.lit((band * 4 + part) << 28)))
    return F.array(*keys)


def fingerprint_documents(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and ``code``, the fingerprint as a signed long, of every row."""

    def work(batches):
        for whole in batches:
            for batch in runs(whole, "text_", RUN_BYTES // 4):  # a shingle takes over a hundred bytes here
                codes = fingerprints(text_bytes(batch.column("text_")), shingle)
                yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(codes.view(np.int64))], names=[id_col, "code"])

    narrow = docs.select(F.col(id_col), F.col(text_col).alias("text_"))
    return narrow.mapInArrow(work, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, code long")


def near_links(codes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that join all fingerprints (distinct, column ``code``) within three bits."""
    keyed = codes.select("code", F.explode(_shards(F.col("code"))).alias("shard"))
    parts = keyed.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1").select("shard", F.ceil(F.col("n") / SHARD).cast("int").alias("parts"))
    parts = stored(parts, "parts")  # so that a crowded key can be split before it is dealt out
    placed = keyed.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("code", "shard"), F.col("parts")).cast("int"))
    blocks = placed.select("shard", "code", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    blocks = blocks.select("shard", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "code")
    dealt = blocks.repartition("shard", "x", "y").sortWithinPartitions("shard", "x", "y")
    return dealt.mapInArrow(lambda batches: _link_batches(batches, 3), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id
    that is reached over links of three differing bits at most."""
    marked = stored(fingerprint_documents(docs, shingle, id_col, text_col), "codes")
    nodes = stored(marked.groupBy("code").agg(F.min(id_col).alias("least")), "nodes")
    label = connected_components(near_links(nodes.select("code"))).select(F.col("node").alias("code"), "label")
    classed = nodes.join(label, "code", "left").select("code", "least", F.coalesce("label", "code").alias("label"))
    least = classed.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = classed.select("code", "label").join(least, "label").select("code", "component_id")
    named = marked.join(classes, "code")
    return named.select(id_col, F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id; all columns stay.

    Rows that repeat a kept id stay with it; rows whose id is null stay, as no decision can name them.
    """
    away = near_duplicates(docs, shingle, id_col, text_col).filter(F.col(id_col) != F.col("component_id"))
    key = free_name(docs, "away_id")
    away = away.select(F.col(id_col).alias(key)).distinct()
    return docs.join(away, docs[id_col] == away[key], "left_anti")
