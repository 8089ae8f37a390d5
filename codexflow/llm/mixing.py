"""Mixing sources to target weights, with DataFrame functions only.

Words are summed by source. Sources share ``share`` of all words by their weights, none above ``most`` times its own: as
in filling vessels of such heights and widths, there is one level, and a source's target is its weight times
the level or its cap. In the order of cap over weight the level is the largest of (budget - caps before) /
(weights from here on), so running sums give it without rounds. A document is emitted floor(rate) times, with
rate its source's target over its words, and once more if a number drawn from the hash of its id and text is below
the rest of the rate. The same rows give the same mix, on any number of machines.

Order and sums over sources are taken by ranges, not in one task. Only sums, not texts, are shuffled; targets come back by
a join whose other side is stored, so that a hot source is split.

Defined results: a null or blank text has size 0 and is taken like any other row (its words are none); a null source
is one source, the last; sources without words have target 0 and rate 0; rows that repeat id and text
share their fate; a null id draws by the text alone; an empty table gives no rows; other columns are
ignored by ``plan_mix`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import free_name, stored
from codexflow.operators.ordering import total_order

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, over and over; words of the mix over all words; most copies of a document.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(identifier: Column, text: Column) -> Column:
    """A number in [0, 1) by the hash of the seed, the id and the text."""
    key = F.md5(F.concat(F.lit(f"{SEED}|"), F.coalesce(identifier.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` (words) of every source of ``sizes`` (``source``, ``size``)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = total_order(sources, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    sources = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    filled = total_order(sources.drop("place"), [F.col("cap") / F.col("weight"), F.col("source")], "place", {"caps": "cap", "weights": "weight"})
    whole = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("all"))
    rest = (F.col("words") * F.lit(share) - F.col("caps")).alias("rest")
    level = filled.crossJoin(F.broadcast(whole)).select(rest, (F.col("all") - F.col("weights")).alias("open"))
    level = level.agg(F.max_by(F.struct("rest", "open"), F.col("rest") / F.col("open")).alias("level"))  # one row
    part = F.col("level.rest") * F.col("weight") / F.col("level.open")
    return filled.crossJoin(F.broadcast(level)).select("source", "source_size", F.least(F.col("cap").cast("double"), part).alias("target"))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: the id, ``size`` (words), ``source_size``, ``target`` of its source, ``rate`` and ``copies``."""
    text = F.col(text_col)
    sized = stored(docs.select(F.col(id_col).alias("id_"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), _draw(F.col(id_col), text).alias("draw")), "sizes")
    shares = stored(targets(sized, weights, share, most), "targets").withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sized.join(shares, F.col("source").eqNullSafe(F.col("of"))).withColumn("rate", rate)
    whole = F.floor("rate")
    copies = whole + (F.col("draw") < F.col("rate") - whole).cast("long")
    return joined.select(F.col("id_").alias(id_col), "size", "source_size", "target", "rate", copies.alias("copies"), F.col("draw"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns stay. The rows are drawn where they
    stand: only the rates of sources are joined to them."""
    sized = docs.select(F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    shares = stored(targets(sized, weights, share, most), "targets")
    of, rate = free_name(docs, "of"), free_name(docs, "rate")
    rates = shares.select(F.col("source").alias(of), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias(rate))
    joined = docs.join(rates, docs[source_col].cast("string").eqNullSafe(rates[of]))
    whole = F.floor(F.col(rate))
    copies = whole + (_draw(F.col(id_col), F.col(text_col)) < F.col(rate) - whole).cast("long")
    copy = free_name(docs, "copy")
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
