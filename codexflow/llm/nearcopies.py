"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash comes first: every shingle set has a 64-bit code, codes of three bits' difference at most are linked by
the BK-trees of ``simhash``, and what hangs together by them has a key in common. The codes of pairs of that similarity
differ in up to 17 bits, though, a radius for which no bands are both selective and complete. So further
candidates come from sets of keys: each of ``BANDS`` keys is a
digest of ``ROWS`` minima of the shingles' hashes, and a pair of similarity s shares one with
probability 1 - (1 - s^ROWS)^BANDS, 0.998 at 0.8. Keys only propose, and only pairs whose sets
reach the similarity are linked. What hangs together by keys is compared in one task if it has ``PART`` members
at most. Larger ones, which may be long chains of documents that have little in common, fall into the groups
of their heads, the least member of each key: pairs that share a key share its head. Every member is compared
with its heads first, which costs a row a head. Only groups whose members that leaves in several components are
dealt out in blocks, one for every two of their parts, so no task holds more than two parts and no pair is lost.

Defined results: equal sets (by a 64-bit digest) are similar, also the empty ones of null, empty or
blank texts; fewer words than a shingle are one shingle; rows with a null id take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import RUN_BYTES, free_name, runs, stored, text_bytes
from codexflow.llm.components import connected_components
from codexflow.llm.simhash import codes_of, near_links

ROWS, BANDS = 6, 20
#: Documents that a part of a group holds.
PART = 500
_TURNS = np.random.default_rng(5).integers(1, 1 << 63, (2, ROWS * BANDS), np.uint64)
_TURNS[0] |= np.uint64(1)


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``shingle`` words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    spans = zip(starts[: 1 - shingle].tolist(), (ends[shingle - 1 :] - 1).tolist())
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans], np.uint64))


def digest(hashes: np.ndarray) -> int:
    """The set's number, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """int64 keys of each set, a row of ``BANDS``; empty sets have zeros."""
    out = np.zeros((len(sets), BANDS), np.int64)
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        first = np.cumsum(sizes[full]) - sizes[full]
        least = np.stack([np.minimum.reduceat(flat * a + b, first) for a, b in _TURNS.T], 1)
        for band in range(BANDS):
            rows = np.ascontiguousarray(least[:, band * ROWS : (band + 1) * ROWS])
            out[full, band] = np.array([xxhash.xxh3_64_intdigest(r.tobytes(), band) for r in rows], np.uint64).view(np.int64)
    return out


def link_sets(sets: list[np.ndarray], similarity: float, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Pairs of places, each of the similarity or more, that join all such pairs; at most one fewer than sets.

    A set is compared with all that aren't joined to it yet, so a group of copies is soon done. Sets of equal
    numbers in ``known`` count as joined from the start.
    """
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    vocabulary, codes = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    ends = np.cumsum(sizes[order])
    parts = [codes[e - n : e] for e, n in zip(ends.tolist(), sizes[order].tolist())]
    label = np.arange(len(sets)) if known is None else np.unique(known, return_inverse=True)[1][order]
    sizes, has, found = sizes[order], np.zeros(len(vocabulary), bool), []
    for i in range(len(parts) - 1):
        if not sizes[i]:
            continue
        last = int(np.searchsorted(sizes, sizes[i] / similarity + 1e-6, "right"))
        rest = i + 1 + np.flatnonzero(label[i + 1 : last] != label[i])
        if not len(rest):
            continue
        has[parts[i]] = True
        common = np.add.reduceat(has[np.concatenate([parts[j] for j in rest])], np.cumsum(sizes[rest]) - sizes[rest], dtype=np.int64)
        has[parts[i]] = False
        for j in rest[common >= similarity * (sizes[i] + sizes[rest] - common) - 1e-9]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                found.append((int(order[i]), int(order[j])))
    return found


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _link_batches(batches, similarity: float):
    """Links of the groups in a stream sorted by label, x and y; groups may span batches."""
    group, nodes, known, sets = None, [], [], []

    def linked():
        return _links([(nodes[i], nodes[j]) for i, j in link_sets(sets, similarity, known)])

    for batch in batches:
        for *key, node, joined, raw in zip(*(batch.column(k).to_pylist() for k in ("label", "x", "y", "node", "known", "hashes"))):
            if key != group:
                if nodes:
                    yield linked()
                group, nodes, known, sets = key, [], [], []
            nodes.append(node)
            known.append(joined)
            sets.append(np.frombuffer(raw, np.uint64))
    if nodes:
        yield linked()


def _star_batches(batches, similarity: float):
    """Links of heads and their members, in a stream sorted by head and part in which the head's own set is first."""
    head, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        found = []
        for key, node, raw in zip(*(batch.column(k).to_pylist() for k in ("head", "node", "hashes"))):
            hashes = np.frombuffer(raw, np.uint64)
            if key == node:
                head, own = key, hashes
            elif key == head and len(own):
                common = len(np.intersect1d(own, hashes, assume_unique=True))
                if common >= similarity * (len(own) + len(hashes) - common) - 1e-9:
                    found.append((key, node))
        yield _links(found)


def mark_documents(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """The id column, ``node`` (the digest of the shingle set), ``keys`` and ``code`` (its SimHash) of every row that has an id."""

    def work(batches):
        for whole in batches:
            for batch in runs(whole, "text_", RUN_BYTES // 4):  # a shingle takes over a hundred bytes here
                sets = [shingle_set(t, shingle) for t in text_bytes(batch.column("text_"))]
                keys = pa.ListArray.from_arrays(np.arange(0, BANDS * len(sets) + 1, BANDS, dtype=np.int32), band_keys(sets).ravel())
                codes = codes_of(np.concatenate([np.zeros(0, np.uint64), *sets]), np.array([len(s) for s in sets], np.int64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([digest(s) for s in sets], pa.int64()), keys, pa.array(codes)], names=[id_col, "node", "keys", "code"])

    narrow = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col), F.col(text_col).alias("text_"))
    return narrow.mapInArrow(work, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, node long, keys array<long>, code long")


def with_code_keys(nodes: DataFrame) -> DataFrame:
    """``nodes`` with one more key each: the least code of those that its own hangs together with, within three bits a link."""
    label = connected_components(near_links(nodes.select("code").distinct())).select(F.col("node").alias("code"), "label")
    keyed = nodes.join(label, "code", "left").withColumn("keys", F.concat("keys", F.array(F.coalesce("label", "code"))))
    return keyed.select(*nodes.columns)


def key_heads(nodes: DataFrame) -> DataFrame:
    """``node`` and ``head``, once each: every node with the least nodes of its keys, where others have the key
    too. Nodes that share a key have that head in common, and a head is a member of its own group."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1").select("key", "head")
    return keyed.join(stored(heads, "heads"), "key").select("node", "head").distinct()  # stored, so that a crowded key can be split


def _with_parts(heads: DataFrame) -> DataFrame:
    """``heads`` with the number of parts of each head's group."""
    return heads.join(stored(heads.groupBy("head").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "parts"), "head")


def star_places(heads: DataFrame) -> DataFrame:
    """``node``, ``head`` and ``part``: a member's part of its head's group; the head itself goes to each part."""
    own = F.array(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    return _with_parts(heads).select("node", "head", F.explode(F.when(F.col("node") == F.col("head"), everywhere).otherwise(own)).alias("part"))


def open_blocks(heads: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``known`` (its component by ``links``), ``label``, ``x`` and ``y`` of the heads' groups whose
    members aren't all of one component: a block for every two parts of a group."""
    near = connected_components(links)
    known = stored(heads.join(near, "node", "left").select("node", "head", F.coalesce("label", "node").alias("known")), "known")
    left = stored(known.groupBy("head").agg(F.min("known").alias("low"), F.max("known").alias("high")).filter("low <> high").select("head"), "open")
    placed = _with_parts(known.join(left, "head")).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    blocks = placed.select("node", "known", F.col("head").alias("label"), "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return blocks.select("node", "known", "label", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"))


def similar_links(docs: DataFrame, nodes: DataFrame, shingle: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """Links ``a``, ``b`` of nodes, all of the similarity or more, that join all such candidates."""
    heads = stored(key_heads(nodes), "groups")
    label = connected_components(heads.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))
    label = stored(label.union(label.select(F.col("label").alias("node"), "label").distinct()), "labels")
    large = stored(label.groupBy("label").agg((F.count("*") > PART).alias("large")), "large")
    picked = nodes.join(label.join(large, "label"), "node").select(F.col("least").alias("least_"), "node", "label", "large")

    def work(batches):
        for whole in batches:
            for batch in runs(whole, "text_", RUN_BYTES // 4):
                sets = [shingle_set(t, shingle) for t in text_bytes(batch.column("text_"))]
                # An id with several texts may stand for several nodes: each row is that of its own text.
                own = pa.array([digest(s) == n for s, n in zip(sets, batch.column("node").to_pylist())], pa.bool_())
                cols = [batch.column(k) for k in ("node", "label", "large")] + [pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["node", "label", "large", "hashes"]).filter(own)

    narrow = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    texts = narrow.join(picked, F.col("id_") == F.col("least_")).select("node", "label", "large", "text_")
    sets = stored(texts.mapInArrow(work, "node long, label long, large boolean, hashes binary"), "sets")

    def linked(blocks):
        dealt = blocks.repartition("label", "x", "y").sortWithinPartitions("label", "x", "y")
        return dealt.mapInArrow(lambda batches: _link_batches(batches, similarity), "a long, b long")

    whole = linked(sets.filter("not large").select("node", F.col("node").alias("known"), "label", F.lit(0).alias("x"), F.lit(0).alias("y"), "hashes"))
    crowded = sets.filter("large").select("node", "hashes")
    heads = stored(heads.join(crowded.select("node"), "node", "left_semi"), "crowded")
    dealt = crowded.join(star_places(heads), "node").repartition("head", "part").sortWithinPartitions("head", "part", F.col("node") != F.col("head"))
    stars = stored(dealt.mapInArrow(lambda batches: _star_batches(batches, similarity), "a long, b long"), "stars")
    return whole.union(stars).union(linked(crowded.join(open_blocks(heads, stars), "node")))


def drop_near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component of similar ones, that of the smallest id; all columns stay.

    Every document that goes is similar to another of its component. Rows that repeat a kept id stay
    with it; rows whose id is null stay, as no decision can name them.
    """
    marked = stored(mark_documents(docs, shingle, id_col, text_col), "marked")
    nodes = stored(marked.groupBy("node").agg(F.min(id_col).alias("least"), F.first("keys").alias("keys"), F.first("code").alias("code")), "nodes")
    nodes = stored(with_code_keys(nodes), "nodes")
    label = connected_components(similar_links(docs, nodes, shingle, similarity, id_col, text_col))
    classed = nodes.select("node", "least").join(label, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    least = classed.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = classed.select("node", "label").join(least, "label").select("node", "component_id")
    key = free_name(docs, "away_id")
    away = marked.select(id_col, "node").join(classes, "node").filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(key)).distinct()
    return docs.join(away, docs[id_col] == away[key], "left_anti")
