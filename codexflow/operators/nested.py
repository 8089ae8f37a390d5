"""Diffs of nested documents: articles, their paragraphs, and text operations of paragraphs that changed.

Articles meet in one full join by their keys; paragraphs are aligned by expressions over the two arrays of an article's
row, so nothing below an article is shuffled. Only the texts of changed paragraphs pass through Python, in Arrow batches.

Defined results: a missing side of an article makes it added or removed, whole; paragraphs meet by number if both
sides have some and every one has a number (of equal numbers the last earlier one counts), else by place; null arrays
count as empty; a paragraph of place that changed its number alone is modified, one met by number can't be.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.operators.batches import slices
from codexflow.operators.textdiff import text_operations

PARAGRAPH = "struct<paragraph_no:string,text:string>"
ARTICLE = f"struct<article_no:string,caption:string,paragraphs:array<{PARAGRAPH}>>"
_STEP = "struct<change:string,paragraph_no:string,old:string,new:string>"
_OPS = "array<struct<op:string,text:string>>"
#: Characters of both texts up to which a pair's operations are kept for the next equal pair, and pairs that are kept.
SHORT, MOST_KEPT = 256, 10_000


def _step(change: str | Column, number: Column, old: Column | None, new: Column | None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct((F.lit(change) if isinstance(change, str) else change).alias("change"), number.alias("paragraph_no"), (none if old is None else old).alias("old"), (none if new is None else new).alias("new"))


def _by_number(old: Column, new: Column) -> Column:
    """Paragraphs of the new side in their order, then the old ones whose number is gone."""
    met = lambda p: F.element_at(F.filter(old, lambda q: q.paragraph_no == p.paragraph_no), -1)
    known = lambda p: F.exists(old, lambda q: q.paragraph_no == p.paragraph_no)
    here = F.transform(new, lambda p: F.when(~known(p), _step("added", p.paragraph_no, None, p.text)).otherwise(_step(F.when(met(p).text == p.text, "unchanged").otherwise("modified"), p.paragraph_no, met(p).text, p.text)))
    gone = F.filter(old, lambda q: ~F.exists(new, lambda p: p.paragraph_no == q.paragraph_no))
    return F.concat(here, F.transform(gone, lambda q: _step("removed", q.paragraph_no, q.text, None)))


def _by_place(old: Column, new: Column) -> Column:
    def at(i):
        p, q = F.get(new, i), F.get(old, i)
        same = p.text.eqNullSafe(q.text) & p.paragraph_no.eqNullSafe(q.paragraph_no)
        both = _step(F.when(same, "unchanged").otherwise("modified"), p.paragraph_no, q.text, p.text)
        return F.when(i >= F.size(old), _step("added", p.paragraph_no, None, p.text)).when(i >= F.size(new), _step("removed", q.paragraph_no, q.text, None)).otherwise(both)

    most = F.greatest(F.size(old), F.size(new))
    return F.when(most > 0, F.transform(F.sequence(F.lit(0), most - 1), at)).otherwise(F.array().cast(f"array<{_STEP}>"))


def paragraph_steps(old: Column, new: Column) -> Column:
    """``change``, ``paragraph_no``, ``old`` and ``new`` text of the aligned paragraphs of two arrays."""
    empty = F.array().cast(f"array<{PARAGRAPH}>")
    both = F.struct(F.coalesce(old, empty).alias("o"), F.coalesce(new, empty).alias("n"))
    numbered = lambda side: (F.size(side) > 0) & F.forall(side, lambda p: p.paragraph_no.isNotNull())
    return F.get(F.transform(F.array(both), lambda b: F.when(numbered(b.o) & numbered(b.n), _by_number(b.o, b.n)).otherwise(_by_place(b.o, b.n))), F.lit(0))


def article_pairs(earlier: DataFrame, later: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``old`` and ``new`` (structs of ``ARTICLE``) of all articles of either side; null where one is missing."""
    a, b = earlier.select(*keys, F.col("article").alias("old")), later.select(*keys, F.col("article").alias("new"))
    return a.join(b, keys, "full_outer")


def _operations(before: str, after: str) -> tuple[tuple[str, str], ...]:
    return tuple(text_operations(before, after))


def _said(steps: pa.Array, kept: Callable[[str, str], tuple[tuple[str, str], ...]]) -> pa.Array:
    """Lists of steps with ``text`` (added, removed) or ``text_diff`` (modified) instead of both texts; only modified texts leave Arrow."""
    change, number, old, new = steps.flatten().flatten()
    modified = pc.equal(change, "modified")
    removed, added = (pc.equal(change, kind).to_numpy(zero_copy_only=False) for kind in ("removed", "added"))
    place = np.arange(len(change)) + np.where(added, len(change), 0)
    text = pa.concat_arrays([old, new]).take(pa.array(place, mask=~(removed | added)))  # ``if_else`` cuts strings of sliced arrays wrongly
    sizes, ops, texts = np.zeros(len(change), np.int32), [], []
    sides = [pc.fill_null(side.filter(modified), "").to_pylist() for side in (old, new)]
    for at, a, b in zip(np.flatnonzero(modified.to_numpy(zero_copy_only=False)), *sides):
        found = (kept if len(a) + len(b) <= SHORT else _operations)(a, b)
        sizes[at] = len(found)
        for op, said in found:
            ops.append(op)
            texts.append(said)
    listed = lambda lengths, values, mask: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values, mask=mask)
    diff = listed(sizes, pa.StructArray.from_arrays([pa.array(ops, pa.string()), pa.array(texts, pa.string())], ["op", "text"]), pc.invert(modified))
    rows = pa.StructArray.from_arrays([change, number, text, diff], ["change", "paragraph_no", "text", "text_diff"])
    return listed(pc.fill_null(pc.list_value_length(steps), 0).to_numpy(), rows, steps.is_null())


def diff_articles(pairs: DataFrame, unchanged: bool = False) -> DataFrame:
    """``change``, ``from_article``, ``to_article`` and ``paragraphs`` beside the other columns of ``pairs``.

    Of an article that came or went the whole side is there; of a modified one the heads (number and caption), and its
    paragraphs with their ``change``, ``paragraph_no``, ``text`` (added, removed) and ``text_diff`` (modified).
    """
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old").eqNullSafe(F.col("new")), "unchanged").otherwise("modified")
    marked = pairs.filter("old is not null or new is not null").withColumn("change", change)
    if not unchanged:
        marked = marked.filter("change <> 'unchanged'")
    head = lambda side: F.struct(F.col(f"{side}.article_no").alias("article_no"), F.col(f"{side}.caption").alias("caption"), F.when(F.col("change") != "modified", F.col(f"{side}.paragraphs")).alias("paragraphs"))
    steps = F.when(F.col("change") == "modified", paragraph_steps(F.col("old.paragraphs"), F.col("new.paragraphs")))
    keys = [c for c in pairs.columns if c not in ("old", "new")]
    shaped = marked.select(
        *keys, "change",
        F.when(F.col("change").isin("removed", "modified"), head("old")).alias("from_article"),
        F.when(F.col("change").isin("added", "modified"), head("new")).alias("to_article"),
        steps.alias("steps"),
    )

    def work(batches):
        kept = lru_cache(MOST_KEPT)(_operations)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _said(batch.column(batch.num_columns - 1), kept)], names=[*batch.schema.names[:-1], "paragraphs"])

    paragraphs = f"array<struct<change:string,paragraph_no:string,text:string,text_diff:{_OPS}>>"
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in shaped.schema.fields[:-1]]
    return shaped.mapInArrow(work, ", ".join([*fields, f"paragraphs {paragraphs}"]))


def diff_counts(changes: DataFrame, keys: list[str]) -> DataFrame:
    """``added``, ``removed``, ``modified`` and ``unchanged`` articles of every ``keys``."""
    return changes.groupBy(*keys).agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "modified", "unchanged")])


def text_of(ops: Column, side: str) -> Column:
    """The ``old`` or the ``new`` text that operations come from."""
    kept = F.filter(ops, lambda o: o.op != ("insert" if side == "old" else "delete"))
    return F.array_join(F.transform(kept, lambda o: o.text), "")
