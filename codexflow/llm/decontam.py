"""Benchmark decontamination with DataFrame functions only.

The windows of the benchmark (``width`` consecutive words of an item; a shorter item is one window)
become a table keyed by a 64-bit hash, which is broadcast after its size has been checked. Each
document is scanned once: its words give one hash for every window position, the positions probe the
broadcast hash table, and the few that meet a key are verified word by word. Per document one row
without a window passes the filter too, so the word count needs no second scan and only rows of
hits, not words, are shuffled. A larger table of windows is stored and joined by a shuffle of the positions' hashes
alone, a few bytes a word; what meets a key goes back to its document, where the words are compared.

Defined results: a null or empty text has no words and no hit; items without words give no window;
an empty benchmark or an empty document table gives no hit or no row; equal items all count, by
their ids; repeated document rows give a row each; other columns are ignored by ``find_hits`` and
kept by the two removers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import ascii_lower, free_name, stored

#: What counts as a word once A-Z are in lower case, and the same before that.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows of the benchmark that are broadcast; more are joined by a shuffle.
BROADCAST_WINDOWS = 300_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _starts(size: Column, length: int | Column) -> Column:
    """0, 1, ... for every window of ``length`` words, empty if there is none."""
    return F.when(size >= length, F.sequence(F.lit(0), (size - length).cast("int"))).otherwise(F.array().cast("array<int>"))


def _window_hashes(length: int) -> Column:
    """Hash of every window of ``length`` words of ``w``."""
    return F.transform(_starts(F.size("w"), length), lambda i: F.xxhash64(F.slice("w", i + 1, length)))


def item_windows(items: DataFrame, width: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct windows: ``key`` (hash), ``window`` (its words), ``item_ids`` (of all items that have it)."""
    cut = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(width))
    at = cut.select("item", "w", length.alias("n"), F.explode(_starts(F.size("w"), length)).alias("at"))
    windows = at.select("item", F.slice("w", F.col("at") + 1, F.col("n")).alias("window"))
    grouped = windows.groupBy("window").agg(F.collect_set("item").alias("item_ids"))
    return grouped.select(F.xxhash64("window").alias("key"), "window", F.array_sort("item_ids").alias("item_ids"))


def find_hits(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document row: the id, ``n_words``, ``n_hit`` (words inside any occurrence of a window),
    ``item_ids`` (sorted strings of items with an occurring window) and ``spans`` (hit windows as
    word ranges, sorted)."""
    windows = item_windows(items, width, item_col, item_text_col)
    sizes = windows.groupBy(F.size("window").alias("n")).count().collect()  # width rows at most
    lengths = sorted(r["n"] for r in sizes)
    if sum(r["count"] for r in sizes) > BROADCAST_WINDOWS:
        return _hits_by_shuffle(docs, stored(windows, "windows"), lengths, id_col, text_col)
    windows = F.broadcast(windows)
    cut = docs.select(F.monotonically_increasing_id().alias("row_"), F.col(id_col).alias("id_"), words(F.col(text_col)).alias("w"))
    cut = cut.withColumn("n_words", F.size("w"))
    probed = cut.select("row_", "id_", "n_words", "w", F.posexplode_outer(_probes(lengths)).alias("place", "key"))
    start = _start(lengths)
    joined = probed.join(windows, "key", "left").filter(F.col("window").isNotNull() | F.coalesce(F.col("place") == 0, F.lit(True)))
    placed = joined.withColumn("start", start).withColumn("n", F.size("window"))
    hit = F.coalesce(F.slice("w", F.col("start") + 1, F.greatest(F.col("n"), F.lit(0))) == F.col("window"), F.lit(False))
    rows = placed.select(
        "row_", "id_", "n_words",
        F.when(hit, F.struct(F.col("start"), (F.col("start") + F.col("n")).alias("stop"))).alias("span"),
        F.when(hit, F.col("item_ids")).alias("item_ids"),
    )
    found = rows.groupBy("row_", "id_", "n_words").agg(F.array_sort(F.collect_list("span")).alias("spans"), F.collect_set("item_ids").alias("sets"))
    return _report(found, id_col)


def _probes(lengths: list[int]) -> Column:
    """Hashes of all windows of ``w``, those of one length after those of the shorter ones."""
    hashes = [_window_hashes(n) for n in lengths]
    return F.concat(*hashes) if hashes else F.array().cast("array<bigint>")


def _start(lengths: list[int]) -> Column:
    """The word at which the window of ``place`` among ``_probes`` begins."""
    start, before = F.col("place"), F.lit(0)
    for n in lengths[:-1]:
        before = before + F.greatest(F.col("n_words") - n + 1, F.lit(0))
        start = F.when(F.col("place") >= before, F.col("place") - before).otherwise(start)
    return start


def _report(found: DataFrame, id_col: str) -> DataFrame:
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(F.greatest(a.end, s.stop).alias("end"), (a.n + F.greatest(F.lit(0), s.stop - F.greatest(a.end, s.start))).alias("n")),
        lambda a: a.n,
    )
    return found.select(
        F.col("id_").alias(id_col), F.col("n_words").cast("long"), covered.cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("sets"))).alias("item_ids"), "spans",
    )


def _hits_by_shuffle(docs: DataFrame, windows: DataFrame, lengths: list[int], id_col: str, text_col: str) -> DataFrame:
    """As ``find_hits``, for windows that aren't broadcast. A document is named by its id and the hash of its text,
    so rows that repeat both share their hits."""
    named = docs.select(F.col(id_col).alias("id_"), F.coalesce(F.col(text_col), F.lit("")).alias("text_"))
    named = named.withColumn("hash_", F.xxhash64("text_"))
    cut = named.select("id_", "hash_", words(F.col("text_")).alias("w")).withColumn("n_words", F.size("w"))
    probed = cut.select("id_", "hash_", "n_words", F.posexplode(_probes(lengths)).alias("place", "key"))
    met = probed.select("id_", "hash_", _start(lengths).alias("start"), "key").join(windows, "key")
    met = met.groupBy(F.col("id_").alias("of"), F.col("hash_").alias("of_hash")).agg(F.collect_set(F.struct("start", "window", "item_ids")).alias("met"))
    back = named.join(met, F.col("id_").eqNullSafe(F.col("of")) & (F.col("hash_") == F.col("of_hash")), "left")
    back = back.select("id_", words(F.col("text_")).alias("w"), "met").withColumn("n_words", F.size("w"))
    hits = F.filter(F.coalesce("met", F.array().cast(back.schema["met"].dataType)), lambda m: F.slice("w", m.start + 1, F.size(m.window)) == m.window)
    found = back.select("id_", "n_words", hits.alias("hits")).select(
        "id_", "n_words",
        F.array_sort(F.transform("hits", lambda m: F.struct(m.start.alias("start"), (m.start + F.size(m.window)).alias("stop")))).alias("spans"),
        F.transform("hits", lambda m: m.item_ids).alias("sets"),
    )
    return _report(found, id_col)


def drop_documents(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a window; all their columns stay."""
    hits = find_hits(docs, items, width, id_col, text_col).filter("n_hit > 0")
    key = free_name(docs, "hit_id")
    hits = hits.select(F.col(id_col).alias(key)).distinct()
    return docs.join(hits, docs[id_col].eqNullSafe(hits[key]), "left_anti")


def drop_spans(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words, and what follows each up to the next word, cut out of their texts."""
    hits = find_hits(docs, items, width, id_col, text_col).filter("n_hit > 0")
    key, spans = free_name(docs, "hit_id"), free_name(docs, "hit_spans")
    hits = hits.groupBy(F.col(id_col).alias(key)).agg(F.flatten(F.collect_set("spans")).alias(spans))
    text = F.col(text_col)
    parts = F.regexp_extract_all(text, F.lit(f"{WORD_ANY_CASE}[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*"), F.lit(0))
    lead = F.regexp_extract(text, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    kept = F.filter(parts, lambda p, i: ~F.exists(F.col(spans), lambda s: (s.start <= i) & (i < s.stop)))
    joined = docs.join(hits, docs[id_col].eqNullSafe(hits[key]), "left")
    return joined.withColumn(text_col, F.when(F.col(spans).isNull(), text).otherwise(F.concat(lead, F.array_join(kept, "")))).select(*[F.col(f"`{c}`") for c in docs.columns])
