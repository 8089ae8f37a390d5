"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Whole texts are lower-cased, everything but letters counts as a space, and the n-grams of one to
three characters are hashed into a fixed number of features with log-scaled counts, inverse document
frequencies and unit length. Weights are trained with follow-the-regularised-leader (per-coordinate
rates, L1 and L2 penalties), on a bounded sample, as many rows of each language as of any other. A
part of the sample that the weights haven't seen sets the temperature of the softmax.

Defined results: a null text or one without a letter is ``und`` with score 0; without any labelled
row every text is ``und``; equal scores go to the language that sorts first; rows with a null lang
or id train nothing; repeated rows get a row each (and train once); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import crc_remainder, received, runs, shipped, worker_state

FEATURES = 1 << 15
#: The sample: rows of all languages together, but one of each at least; one row in five of it calibrates.
SAMPLE_ROWS = 4000
#: Languages up to which the sample's bounds (one row a language) are broadcast.
BROADCAST_LANGUAGES = 100_000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.02, 0.001
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(0x110000)])


def counts(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Features and their counts of each text, None where it has no letter."""
    table = worker_state("langid:letters", _letters)
    lowered = [(x or "").lower() for x in texts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    letter = table[code]
    code = np.where(letter, code, np.uint32(32))
    shift = np.uint32(32 - 15)
    hashes, mixed = [], np.zeros(len(code), np.uint32)
    for n in range(3):
        mixed = (mixed[: len(code) - n] + code[n:]) * _ODD[n] if len(code) > n else mixed[:0]
        mixed ^= mixed >> np.uint32(15)
        hashes.append((mixed * _ODD[0]) >> shift)
    out: list[tuple[np.ndarray, np.ndarray] | None] = []
    at = 0
    for text in lowered:
        end = at + len(text)
        if letter[at:end].any():
            found = np.bincount(np.concatenate([h[at : max(at, end - n)] for n, h in enumerate(hashes)]), minlength=FEATURES)
            features = np.flatnonzero(found)
            out.append((features, found[features]))
        else:
            out.append(None)
        at = end
    return out


def unit(features: np.ndarray, found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of unit length."""
    value = (1 + np.log(found)) * idf[features]
    return value / np.sqrt((value**2).sum())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Model:
    """Sparse weights for each language, inverse document frequencies and a temperature."""

    def __init__(self, rows: list[tuple[str, bool, np.ndarray, np.ndarray]]):
        """Rows are (language, whether it calibrates, features, counts)."""
        self.languages = sorted({r[0] for r in rows})
        self.temperature = 1.0
        if not rows:
            return
        place = {x: i for i, x in enumerate(self.languages)}
        taught = [r for r in rows if not r[1]] or rows
        checked = [r for r in rows if r[1]] or rows
        seen = np.zeros(FEATURES)
        for r in taught:
            seen[r[2]] += 1
        self.idf = (np.log((len(taught) + 1) / (seen + 1)) + 1).astype(np.float32)
        self.weights = self._follow_the_leader([(place[r[0]], r[2], unit(r[2], r[3], self.idf)) for r in taught])
        z = np.array([unit(r[2], r[3], self.idf) @ self.weights[r[2]] for r in checked])
        y = np.array([place[r[0]] for r in checked])
        loss = lambda t: -np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean()
        self.temperature = float(min(np.geomspace(0.02, 20, 200), key=loss))

    def _follow_the_leader(self, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
        k = len(self.languages)
        z, n = np.zeros((FEATURES, k)), np.zeros((FEATURES, k))
        order = np.random.default_rng(7)
        for _ in range(EPOCHS):
            for i in order.permutation(len(rows)):
                y, at, x = rows[i]
                zi, ni = z[at], n[at]
                w = self._weights(zi, ni)
                error = softmax(x @ w)
                error[y] -= 1
                g = x[:, None] * error
                z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
                n[at] = ni + g * g
        return self._weights(z, n).astype(np.float32)

    @staticmethod
    def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for row in counts(texts):
            if row is None or not self.languages:
                names.append("und")
                scores.append(0.0)
                continue
            p = softmax((unit(*row, self.idf) @ self.weights[row[0]]).astype(np.float64) / self.temperature)
            best = int(p.argmax())
            names.append(self.languages[best])
            scores.append(float(p[best]))
        return names, scores


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on rows with a language whose crc32(id) modulo 4 isn't 2: of each language those of the
    lowest hash. Features are counted by the executors; the driver gets at most ``SAMPLE_ROWS`` rows, or one a language."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (crc_remainder(F.col(id_col), 4) != 2))
    known = known.select(F.col(id_col).alias("key_"), F.col(lang_col).alias("lang_"), F.expr(f"xxhash64(`{id_col}`, 5) & {(1 << 63) - 1}").alias("h_"))
    # Hashes fall into classes, eight for each halving, so the lowest rows are told from the rest by counts of
    # classes, which combine before the shuffle; no task gets a language's rows.
    known = known.withColumn("class_", F.expr("cast(8 * (63 - log2(h_ + 1.0D)) as int)"))
    classes = known.groupBy("lang_", "class_").count()
    classes = classes.withColumn("lower", F.expr("sum(count) over (partition by lang_ order by class_ desc) - count"))
    many = classes.select("lang_").distinct().count()
    if not many:
        return Model([])
    per, most = max(1, SAMPLE_ROWS // many), max(SAMPLE_ROWS, many)
    bound = classes.filter(F.col("lower") < per).groupBy("lang_").agg(F.min("class_").alias("bound_"))
    low = known.join(F.broadcast(bound) if many <= BROADCAST_LANGUAGES else bound, "lang_").filter("class_ >= bound_")
    ranked = low.withColumn("rank_", F.expr("row_number() over (partition by lang_ order by h_, key_)"))
    picked = ranked.filter(F.col("rank_") <= per).select("key_", "lang_", "h_").distinct().orderBy("h_", "key_").limit(most)
    texts = docs.filter(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("key_"), F.col(lang_col).alias("lang_"), F.col(text_col).alias("text_"))

    def count(batches):
        for batch in batches:
            got = counts(batch.column("text_").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang_"), batch.column("h_"), pa.array([g and g[0].tolist() for g in got], pa.list_(pa.int32())), pa.array([g and g[1].tolist() for g in got], pa.list_(pa.int32()))],
                names=["lang", "h", "features", "counts"],
            )

    rows = texts.join(F.broadcast(picked), ["key_", "lang_"]).select("lang_", "h_", "text_").mapInArrow(count, "lang string, h long, features array<int>, counts array<int>")
    rows = rows.filter("features is not null").groupBy("h", "lang").agg(F.min(F.struct("features", "counts")).alias("row")).select("h", "lang", "row.*")
    got = rows.orderBy("h", "lang").limit(most).toArrow()
    return Model(
        [
            (lang, h % 5 == 0, np.array(f, np.int64), np.array(c, np.int64))
            for lang, h, f, c in zip(*(got.column(k).to_pylist() for k in ("lang", "h", "features", "counts")))
        ]
    )


def predict_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``held_out`` (crc32(id) modulo 4 is 2), ``lang_pred`` and ``score`` of every row."""
    shared = shipped(docs.sparkSession, model)  # FEATURES x languages floats

    def work(batches):
        known = received(shared)
        for whole in batches:
            for batch in runs(whole, "text_"):
                names, scores = known.predict(batch.column("text_").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[id_col, "held_out", "lang_pred", "score"],
                )

    narrow = docs.select(F.col(id_col), (crc_remainder(F.col(id_col), 4) == 2).alias("held_out"), F.col(text_col).alias("text_"))
    return narrow.mapInArrow(work, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
