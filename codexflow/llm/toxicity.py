"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Training takes a bounded sample of labelled rows. Its texts fall into clusters by their common words,
mostly one a language; each cluster, and all together, has an equal part of both dictionaries, so that
what is rare in the whole corpus isn't lost. In one half of the sample, whole words and strings of 5 to
8 bytes that are much more frequent in toxic than in ordinary documents of a cluster name the stretches
that fill its part of the toxic dictionary, the most frequent ones last, where zstandard reaches them
most cheaply; the most frequent words of ordinary documents fill the other. A window is one word between fixed carrier bytes that both
dictionaries hold, since zstandard stores very short inputs as they are and doesn't search their
last bytes. A window's gain is the length it has with the ordinary dictionary less that with the
toxic one. The other half of the sample calibrates: logistic regression, weighted to the labels' true
proportions, turns a document's highest gains, their sum and number and its number of windows into a score.

Scoring reads every word of every text; a worker keeps the gains of words it has met in a bounded
memory.

Defined results: a null, empty or blank text has no window and takes the score of a document without
gains; without labelled rows of both classes every score is the share of toxic labels (0 if there
are none); labels of one document that differ count as toxic; repeated rows get a row each; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import crc_remainder, received, shipped, worker_state

#: The sample: rows of each class at most, and text bytes of a class at most (but one row, however long).
SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_BYTES = 2000, 4000, 64 << 20
#: Lengths of the substrings that are compared between the classes, beside whole words.
GRAMS = (5, 6, 8)
#: A gram is toxic if it is in so many times the share of toxic documents as of ordinary ones, and if the
#: number of these times the logarithm of the ratio is ``EVIDENCE`` at least. These and the constants of clusters and
#: dictionaries were compared by four-fold cross-validation inside the rows that may be learned from (README).
CONTRAST, EVIDENCE = 60.0, 16.0
#: Clusters of texts, the common words that tell them apart, and the ordinary texts that a cluster needs.
CLUSTERS, COMMON, LEAST = 8, 300, 20
DICTIONARY_BYTES, LEVEL = 2048, 3
CACHE_WORDS = 300_000
FEATURES = 6
_BEFORE, _AFTER = bytes(range(0x80, 0x98)), bytes(range(0xA8, 0xBC))


def windows(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _grams(word: str) -> set[bytes]:
    raw = f" {word} ".encode()
    return {raw[i : i + n] for n in GRAMS for i in range(len(raw) - n + 1)} | {raw}


def clusters(toxic: list[set[str]], ordinary: list[set[str]]) -> list[tuple[list[int], list[int]]]:
    """Places of the texts of each cluster. Spherical k-means over common words, on ordinary texts alone,
    so that no cluster is that of the toxic ones; the first centres are far from each other."""
    seen = Counter(w for words in ordinary for w in words)
    place = {w: i for i, (w, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:COMMON])}

    def vectors(texts):
        out = np.zeros((len(texts), len(place)))
        for i, words in enumerate(texts):
            out[i, [place[w] for w in words if w in place]] = 1
        return out / np.maximum(np.sqrt(out.sum(1, keepdims=True)), 1)

    x = vectors(ordinary)
    centres = x.mean(0, keepdims=True)
    for _ in range(CLUSTERS - 1):
        # Of the texts with most of the common words, the one least like any centre.
        full = np.flatnonzero((x > 0).sum(1) >= np.median((x > 0).sum(1)))
        centres = np.r_[centres, x[[full[(x[full] @ centres.T).max(1).argmin()]]]]
    for _ in range(15):
        own = (x @ centres.T).argmax(1)
        for k in np.unique(own):
            mean = x[own == k].mean(0)
            centres[k] = mean / max(np.linalg.norm(mean), 1e-9)
    own, theirs = (x @ centres.T).argmax(1), (vectors(toxic) @ centres.T).argmax(1)
    found = [(np.flatnonzero(theirs == k).tolist(), np.flatnonzero(own == k).tolist()) for k in range(CLUSTERS)]
    return [(t, o) for t, o in found if len(o) >= LEAST]


def _stretches(toxic: list[set[str]], ordinary: list[set[str]]) -> list[bytes]:
    """The parts of toxic words that telling grams cover, those of most texts first."""
    shares = []
    for texts in (toxic, ordinary):
        shares.append(Counter())
        for words in texts:
            shares[-1].update(set().union(*map(_grams, words)))
    telling = set()
    for gram, n in shares[0].items():
        ratio = n / len(toxic) * len(ordinary) / (shares[1][gram] + 0.5)
        if n >= max(3, 0.01 * len(toxic)) and ratio >= CONTRAST and n * np.log(ratio) >= EVIDENCE:
            telling.add(gram)
    found: Counter = Counter()
    for word, n in Counter(w for words in toxic for w in words).items():
        raw = f" {word} ".encode()
        at = [(i, i + m) for m in {*GRAMS, len(raw)} for i in range(len(raw) - m + 1) if raw[i : i + m] in telling]
        if at:
            found[raw[min(a for a, _ in at) : max(b for _, b in at)]] += n
    return sorted(found, key=lambda x: (-found[x], x))


def _filled(parts: list[list[bytes]], size: int) -> bytes:
    """``size`` bytes at most, an equal share of each part, the first of every part last; nothing twice."""
    taken: list[bytes] = []
    held, left, at = b"", size, [0] * len(parts)
    while any(at[k] < len(p) for k, p in enumerate(parts)):
        for k, part in enumerate(parts):
            while at[k] < len(part) and part[at[k]] in held:
                at[k] += 1
            if at[k] < len(part):
                new, at[k] = part[at[k]], at[k] + 1
                if len(new) > left:
                    return b"".join(taken[::-1])
                taken.append(new)
                held, left = held + b"\xff" + new, left - len(new)
    return b"".join(taken[::-1])


class Dictionaries:
    """Both dictionaries and the gain of a window."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.parts = toxic, ordinary
        self.shorter = []
        for part in self.parts:
            held = zstandard.ZstdCompressionDict(part[-DICTIONARY_BYTES:] + _AFTER + _BEFORE, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.shorter.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))
        self.known: dict[str, int] = {}

    @classmethod
    def train(cls, toxic: list[str], ordinary: list[str]) -> Dictionaries:
        words = [[set(windows(t)) for t in texts] for texts in (toxic, ordinary)]
        groups = [words] + [[[words[0][i] for i in t], [words[1][i] for i in o]] for t, o in clusters(*words)]
        plain = []
        for _, texts in groups:
            seen = Counter(w for own in texts for w in own)
            plain.append([f" {w}".encode() for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:4000]])
        return cls(_filled([_stretches(t, o) for t, o in groups if t], DICTIONARY_BYTES), _filled(plain, DICTIONARY_BYTES))

    def gains(self, words: list[str]) -> list[int]:
        """How many bytes shorter each window is with the toxic dictionary."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        toxic, ordinary = (x.compress for x in self.shorter)
        for word in set(words).difference(self.known):
            framed = _BEFORE + f" {word} ".encode() + _AFTER
            self.known[word] = len(ordinary(framed)) - len(toxic(framed))
        return list(map(self.known.__getitem__, words))

    def features(self, text: str | None) -> list[float]:
        """The three highest gains, by how much they exceed 0, and logarithms: of the sum of the gains of 2 and
        more, of their number, and of the number of windows."""
        gains = self.gains(windows(text))
        top = sorted(gains, reverse=True)[:3]
        high = [x for x in gains if x > 1]
        return [float(max(0, x)) for x in top + [0] * (3 - len(top))] + np.log1p([sum(high), len(high), len(gains)]).tolist()


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and coefficients (the constant last) of a ridge logistic regression, by Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    beta, ridge = np.zeros(z.shape[1]), np.diag([1e-2] * x.shape[1] + [1e-6]) * len(x) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge @ beta
        step = np.linalg.solve((z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + ridge, slope)
        beta -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta


class Model:
    """What scoring needs: dictionary bytes and the calibration, or a constant score."""

    def __init__(self, toxic: list[tuple[str, bool]], ordinary: list[tuple[str, bool]], share: float):
        """Rows are (text, whether it calibrates); ``share`` is that of toxic labels among all."""
        self.constant, self.parts = share, None
        taught = [[t for t, late in rows if not late] for rows in (toxic, ordinary)]
        checked = [[t for t, late in rows if late] for rows in (toxic, ordinary)]
        if not toxic or not ordinary:
            return
        taught = [a or b for a, b in zip(taught, checked)]
        checked = [a or b for a, b in zip(checked, taught)]
        found = Dictionaries.train(*taught)
        self.parts = found.parts
        x = np.array([found.features(t) for rows in checked for t in rows])
        y = np.repeat([1.0, 0.0], [len(rows) for rows in checked])
        weight = np.where(y == 1, share / len(checked[0]), (1 - share) / len(checked[1])) * len(y)
        self.mean, self.scale, self.beta = calibrate(x, y, weight)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.parts is None:
            return np.full(len(texts), self.constant)
        found = worker_state(f"toxicity:{hash(self.parts)}", lambda: Dictionaries(*self.parts))
        x = np.array([found.features(t) for t in texts]).reshape(len(texts), FEATURES)
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))] @ self.beta
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows whose crc32(id) modulo 5 isn't 0: of each class those of the lowest hash, long
    texts like short ones, up to ``SAMPLE_TOXIC`` or ``SAMPLE_ORDINARY`` rows and ``SAMPLE_BYTES``."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (crc_remainder(F.col(id_col), 5) != 0))
    known = known.groupBy(F.col(id_col).alias("key_")).agg(F.max(F.col(label_col).cast("int")).alias("y_")).withColumn("h_", F.xxhash64(F.col("key_"), F.lit(11)))
    text = docs.select(F.col(id_col).alias("key_"), F.col(text_col).alias("text_"))
    count = {r["y_"]: r["count"] for r in known.groupBy("y_").count().collect()}  # two rows
    rows = []
    for y, size in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        # Ids first (a top-k without texts), then their sizes, so the texts that travel are bounded before they do.
        picked = known.filter(F.col("y_") == y).orderBy("h_", "key_").limit(size)
        listed = text.join(F.broadcast(picked), "key_").select("key_", "h_", F.coalesce(F.octet_length("text_"), F.lit(0)).alias("size_"))
        sizes = listed.orderBy("h_", "key_", "size_").limit(size).collect()
        fits = [r for r, end in zip(sizes, np.cumsum([r["size_"] for r in sizes])) if end <= SAMPLE_BYTES] or sizes[:1]
        if not fits:
            rows.append([])
            continue
        got = text.join(F.broadcast(picked.filter(F.col("h_") <= fits[-1]["h_"])), "key_").orderBy("h_", "key_", F.octet_length("text_")).limit(len(fits)).collect()
        rows.append([(r["text_"], bool(r["h_"] & 1)) for r in got])
    total = sum(count.values())
    return Model(rows[0], rows[1], count.get(1, 0) / total if total else 0.0)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``held_out`` (crc32(id) modulo 5 is 0), ``score`` and ``predicted`` of every row."""
    shared = shipped(docs.sparkSession, model)  # two dictionaries: 4 KB

    def work(batches):
        known = received(shared)
        for batch in batches:
            score = known.score(batch.column("text_").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                names=[id_col, "held_out", "score", "predicted"],
            )

    narrow = docs.select(F.col(id_col), (crc_remainder(F.col(id_col), 5) == 0).alias("held_out"), F.col(text_col).alias("text_"))
    return narrow.mapInArrow(work, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; columns stay as they are, and nothing is shuffled."""
    shared = shipped(docs.sparkSession, model)
    at = docs.columns.index(text_col)

    def work(batches):
        known = received(shared)
        for batch in batches:
            yield batch.filter(pa.array(known.score(batch.column(at).to_pylist()) < 0.5))

    return docs.mapInArrow(work, docs.schema)
