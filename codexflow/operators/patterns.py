"""Multi-pattern matching of a table of patterns in a table of texts, by shuffle joins.

No task and not the driver holds the dictionary. Every pattern is anchored at one of its grams (``gram`` characters),
the one that is rarest in the texts. A bitmap of the anchors, at most ``MOST_BITS`` bits, goes to the tasks; the
places of a text whose gram meets it are joined with the anchors, and what they propose goes back to its
text, where each pattern is compared with the characters there. Which gram is the anchor and what the bitmap
lets through decides the cost alone, not the rows.

Dictionaries of ``FEW`` patterns at most take a shorter way to the same rows: they go to the tasks as they are and the texts stream past an
automaton, so no hit is shuffled; only a count decides.

Defined results: a null text or pattern is ignored, as are patterns shorter than a gram; repeated patterns count
once, repeated rows of texts each; a text that holds nothing gives no row; ids need not be unique.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.operators.batches import slices
from codexflow.sources.workspace import workspace

#: Bits of the bitmap for each anchor, and bits at most (16 MB).
BITS_EACH, MOST_BITS = 32, 1 << 27
#: Patterns, and characters of them all, up to which a dictionary goes to the tasks.
FEW, FEW_CHARACTERS = 50_000, 2_000_000
#: Characters of text that are hashed at once.
RUN = 1 << 20


def gram_hashes(text: str, gram: int) -> np.ndarray:
    """A 64-bit hash of the characters at every place of ``text`` where a gram begins."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(codes) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(gram):
            found = (found ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(29)
    return found


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pattern_grams(patterns: DataFrame, gram: int) -> DataFrame:
    """``pattern``, ``offset`` and ``key`` (its hash) of every gram of a pattern."""

    def work(batches):
        for batch in slices(batches):
            held = batch.column(0).to_pylist()
            found = [gram_hashes(p, gram) for p in held]
            sizes = [len(f) for f in found]
            names = pa.array(held, pa.string()).take(pa.array(np.repeat(np.arange(len(held)), sizes)))
            offsets = np.concatenate([np.arange(n) for n in sizes] or [np.zeros(0)]).astype(np.int32)
            keys = np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([names, pa.array(offsets), pa.array(keys)], names=["pattern", "offset", "key"])

    return patterns.mapInArrow(work, "pattern string, offset int, key long")


def _bitmap(keys: DataFrame, bits: int) -> Broadcast:
    """The bits that the keys' hashes have, as bytes that every task gets: ``bits`` / 8 of them at most."""
    bit = F.shiftrightunsigned("key", 64 - bits.bit_length() + 1)
    number = keys.select((bit + 1).alias("bit"))  # buckets of 32,768 values begin with 1
    parts = number.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bytes"))
    whole = bytearray(bits // 8)
    for row in parts.collect():  # bits / 32,768 rows
        at = (row["part"] - 1) * 4096
        whole[at : at + 4096] = row["bytes"]
    return keys.sparkSession.sparkContext.broadcast(bytes(whole))


def _met(text: str, gram: int, bitmap: np.ndarray, shift: int):
    """(place, hash) arrays of grams that the bitmap holds, for a run of the text at a time."""
    for at in range(0, max(len(text) - gram + 1, 0), RUN):
        hashes = gram_hashes(text[at : at + RUN + gram - 1], gram)
        bit = hashes >> np.uint64(shift)
        place = np.flatnonzero(bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
        yield place + at, hashes[place]


def _place_batches(batches, gram: int, shared: Broadcast, shift: int, counted: bool):
    """Places and hashes of met grams; if ``counted``, only how often each hash is met in the batch."""
    bitmap = np.frombuffer(shared.value, np.uint8)
    for batch in slices(batches):
        ids, places, keys = [], [], []
        for k, text in enumerate(batch.column("text_").to_pylist()):
            for place, key in _met(text or "", gram, bitmap, shift):
                ids.append(np.full(len(place), k))
                places.append(place)
                keys.append(key)
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        if counted:
            key, many = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(many.astype(np.int64))], names=["key", "n"])
        else:
            row = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64))
            place = np.concatenate(places).astype(np.int32) if places else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id_").take(row), batch.column("hash_").take(row), pa.array(place), pa.array(key.view(np.int64))], names=["id_", "hash_", "place", "key"])


def _proposed(named: DataFrame, patterns: DataFrame, gram: int) -> DataFrame:
    """``of``, ``of_hash`` and ``hits`` (begin, pattern): where anchors propose patterns in texts."""
    grams = _stored(_pattern_grams(patterns, gram), "grams")
    keys = grams.select("key").distinct()
    bits = 1 << min(MOST_BITS, max(1 << 16, BITS_EACH * max(keys.count(), 1))).bit_length() - 1
    shift = 64 - bits.bit_length() + 1
    all_bits = _bitmap(keys, bits)
    counts = named.select("text_").mapInArrow(lambda b: _place_batches(b, gram, all_bits, shift, True), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # Grams that no text has are the rarest of all: their patterns occur nowhere and drop out of the join.
    anchors = grams.join(counts, "key", "left").groupBy("pattern").agg(F.min_by(F.struct("key", "offset"), F.struct(F.coalesce("n", F.lit(0)), "offset")).alias("a"), F.min(F.coalesce("n", F.lit(0))).alias("n"))
    anchors = _stored(anchors.filter("n > 0").select("pattern", "a.key", "a.offset"), "anchors")
    anchor_bits = _bitmap(anchors.select("key").distinct(), bits)
    kind = named.schema["id_"].dataType.simpleString()
    places = named.mapInArrow(lambda b: _place_batches(b, gram, anchor_bits, shift, False), f"id_ {kind}, hash_ long, place int, key long")
    met = places.join(anchors, "key").select("id_", "hash_", (F.col("place") - F.col("offset")).alias("begin"), "pattern").filter("begin >= 0")
    return met.groupBy(F.col("id_").alias("of"), F.col("hash_").alias("of_hash")).agg(F.collect_set(F.struct("begin", "pattern")).alias("hits"))


def chosen(hits: list[tuple[int, int, str]], mode: str) -> list[tuple[int, int, str]]:
    """Hits (begin, stop, pattern) that ``mode`` takes: all (``overlapping``), or without overlap the one that ends
    first (``earliest``) or begins first and of those is ``longest``."""
    if mode == "overlapping":
        return sorted(hits, key=lambda h: (h[1], h[0]))
    order = (lambda h: (h[0], -h[1])) if mode == "longest" else (lambda h: (h[1], h[0]))
    kept, at = [], 0
    for hit in sorted(hits, key=order):
        if hit[0] >= at:
            kept.append(hit)
            at = hit[1]
    return kept


def _verified(texts: DataFrame, id_col: str, text_col: str, patterns: DataFrame, pattern_col: str, gram: int, few: int) -> tuple[DataFrame, Broadcast | None]:
    """``id_``, ``text_`` and ``hits`` of the texts that anchors propose patterns for; or all texts, without hits, and the dictionary if it is small."""
    wanted = patterns.select(F.col(pattern_col).alias("pattern")).filter(F.length("pattern") >= gram).distinct()
    named = texts.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    wanted = _stored(wanted, "patterns")
    size = wanted.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("pattern")), F.lit(0)).alias("characters")).first()
    if size["n"] <= few and size["characters"] <= FEW_CHARACTERS:
        words = [r["pattern"] for r in wanted.collect()]  # ``few`` at most
        return named, texts.sparkSession.sparkContext.broadcast(words)
    named = named.withColumn("hash_", F.xxhash64("text_"))
    proposed = _stored(_proposed(named, wanted, gram), "proposed")
    return named.join(proposed, F.col("id_").eqNullSafe(F.col("of")) & (F.col("hash_") == F.col("of_hash"))).select("id_", "text_", "hits"), None


def _hits(batches, words: Broadcast | None, mode: str):
    """Slices of the batches, and of each their ids, texts and the hits that ``mode`` takes."""
    automaton = None
    if words is not None:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word in words.value:
            automaton.add_word(word, word)
        automaton.make_automaton()
    for batch in slices(batches):
        columns = [c.to_pylist() for c in batch.columns]
        if words is None:
            yield batch, ((i, t, _there(t, hits, mode)) for i, t, hits in zip(*columns))
        else:
            held = (lambda t: [(end + 1 - len(p), end + 1, p) for end, p in automaton.iter(t)]) if words.value else (lambda t: [])
            yield batch, ((i, t, chosen(held(t), mode)) for i, t in zip(*columns))


def _there(text: str, hits: list[dict], mode: str) -> list[tuple[int, int, str]]:
    found = [(h["begin"], h["begin"] + len(h["pattern"]), h["pattern"]) for h in hits if text.startswith(h["pattern"], h["begin"])]
    return chosen(found, mode)


def find(texts: DataFrame, id_col: str, text_col: str, patterns: DataFrame, pattern_col: str, gram: int, mode: str = "overlapping", tail: int = 0, few: int = FEW) -> DataFrame:
    """``id``, ``pattern``, ``begin`` and ``stop`` of every hit, and ``rest``, the ``tail`` characters behind it."""

    proposed, words = _verified(texts, id_col, text_col, patterns, pattern_col, gram, few)

    def work(batches):
        for batch, found in _hits(batches, words, mode):
            rows = []
            for i, t, hits in found:
                rows += [(i, p, a, b, t[b : b + tail]) for a, b, p in hits]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "pattern", "begin", "stop", "rest"])

    kind = texts.schema[id_col].dataType.simpleString()
    found = proposed.mapInArrow(work, f"id {kind}, pattern string, begin int, stop int, rest string")
    return found if tail else found.drop("rest")


def held(texts: DataFrame, id_col: str, text_col: str, patterns: DataFrame, pattern_col: str, gram: int, mode: str = "overlapping", few: int = FEW) -> DataFrame:
    """``id`` and ``patterns``, the distinct ones in order, of every text that holds one; and ``lines``, the number of
    its lines that hold each. One row a text."""

    proposed, words = _verified(texts, id_col, text_col, patterns, pattern_col, gram, few)

    def work(batches):
        for batch, every in _hits(batches, words, mode):
            ids, names, lines = [], [], []
            for i, t, found in every:
                if not found:
                    continue
                breaks = [k for k, c in enumerate(t) if c == "\n"] if "\n" in t else []
                seen: dict[str, set[int]] = {}
                for a, b, p in found:
                    line = bisect_left(breaks, a)
                    seen.setdefault(p, set()).update([line] if line == bisect_left(breaks, b - 1) else ())
                ids.append(i)
                names.append(sorted(seen))
                lines.append([len(seen[p]) for p in names[-1]])
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(names, pa.list_(pa.string())), pa.array(lines, pa.list_(pa.int64()))], names=["id", "patterns", "lines"])

    kind = texts.schema[id_col].dataType.simpleString()
    return proposed.mapInArrow(work, f"id {kind}, patterns array<string>, lines array<bigint>")
