"""Pages of comparison tables: the band above (after) and below (before) a divider, with or without headings.

A page's words are few, so they stand in one array of its row (``at``, ``x``, ``y``, ``y1``, ``text``), and all that is
worked out of them are expressions over that array: no word is shuffled after its page has been put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.functions.gazette import is_margin
from codexflow.functions.text import bigram_jaccard

#: Gaps of columns and of heading columns, the middle part of a page where a divider may be, the
#: least words of a page and of a band, and what both bands must have in common in height and text.
COLUMN_GAP, HEADING_GAP, MIDDLE, LEAST_WORDS, LEAST_BAND, HEIGHTS, LIKENESS = 10.0, 6.0, (0.35, 0.65), 8, 3, 0.7, 0.5
WORD = "struct<at:bigint,x:double,y:double,y1:double,text:string>"
BLANK_ENDS = r"(?U)^\s+|\s+$"


def page_words(words: DataFrame, page: str) -> DataFrame:
    """One row a page with its ``words`` in their order."""
    fields = [F.col("at").cast("bigint").alias("at"), *[F.col(c).cast("double").alias(c) for c in ("x", "y", "y1")], F.col("text").cast("string").alias("text")]
    return words.groupBy(page).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("words"))


def _grouped(words: Column, sign: int, gap: float) -> Column:
    """Words by column: ``g`` counts columns in the order of ``sign`` * x; a word opens one if it is farther than ``gap``
    from the first word of the last."""
    ordered = F.array_sort(F.transform(words, lambda w: F.struct((w.x * sign).alias("k"), w.at.alias("at"), w.alias("w"))))
    start = F.struct(F.lit(None).cast("double").alias("head"), F.lit(-1).alias("g"), F.array().cast(f"array<struct<g:int,y:double,k:int,w:{WORD}>>").alias("out"))

    def add(a, o):
        new = a.head.isNull() | (o.k - a.head > gap)
        g = F.when(new, a.g + 1).otherwise(a.g)
        return F.struct(F.when(new, o.k).otherwise(a.head).alias("head"), g.alias("g"), F.concat(a.out, F.array(F.struct(g.alias("g"), o.w.y.alias("y"), F.size(a.out).alias("k"), o.w.alias("w")))).alias("out"))

    return F.array_sort(F.aggregate(ordered, start, add, lambda a: a.out))


def _let(value: Column, say) -> Column:
    """``say(value)`` with ``value`` worked out once a row, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), say), F.lit(0))


def reading_text(words: Column) -> Column:
    """Text of words in reading order: columns from the right, each from its top; margins are left out."""
    said = lambda placed, g: F.array_join(F.transform(F.filter(placed, lambda p: p.g == g), lambda p: p.w.text), "")
    columns = lambda placed: F.transform(F.array_distinct(F.transform(placed, lambda p: p.g)), lambda g: said(placed, g))
    lines = _let(_grouped(words, -1, COLUMN_GAP), columns)
    return F.regexp_replace(F.array_join(F.filter(lines, lambda x: ~is_margin(x)), "\n"), BLANK_ENDS, "")


def _middle(w: Column) -> Column:
    return (w.y + w.y1) / 2


def heading_place(words: Column) -> Column:
    """``header_x`` and ``divider`` of the first column from the left that spells both headings; else null."""

    def spelled(own, letters):
        said = F.array_join(F.transform(letters, lambda x: x.c), "")
        mean = lambda at: sum((F.get(letters, at + k).m for k in (-1, 0, 1)), F.lit(0.0)) / 3
        new, old = F.instr(said, "改正後"), F.instr(said, "改正前")
        place = F.struct(F.array_min(F.transform(own, lambda p: p.w.x)).alias("header_x"), ((mean(new) + mean(old)) / 2).alias("divider"))
        return F.when((F.size(own) >= LEAST_BAND) & (new > 0) & (old > 0), place)

    def column(own):
        letters = F.flatten(F.transform(own, lambda p: F.transform(F.filter(F.split(p.w.text, ""), lambda c: c != ""), lambda c: F.struct(c.alias("c"), _middle(p.w).alias("m")))))
        return _let(letters, lambda found: spelled(own, found))

    columns = lambda placed: F.transform(F.array_distinct(F.transform(placed, lambda p: p.g)), lambda g: _let(F.filter(placed, lambda p: p.g == g), column))
    return F.get(F.filter(_let(_grouped(words, 1, HEADING_GAP), columns), lambda h: h.isNotNull()), F.lit(0))


def quiet_divider(words: Column, height: Column) -> Column:
    """Divider of a page without headings: the quietest line of the middle (fewest words cross it, the first of equals), if both
    bands are about as high and say about the same; else null."""
    low, high = (height * k for k in MIDDLE)
    cuts = F.filter(F.transform(words, lambda w: F.struct(w.at.alias("at"), (w.y1 + 0.5).alias("cut"))), lambda c: (c.cut >= low) & (c.cut <= high))
    counted = F.transform(cuts, lambda c: F.struct(F.size(F.filter(words, lambda d: (d.y < c.cut) & (c.cut < d.y1))).alias("n"), c.at.alias("at"), c.cut.alias("cut")))
    tall = lambda band: F.array_max(F.transform(band, lambda w: w.y1)) - F.array_min(F.transform(band, lambda w: w.y))
    bare = lambda band: F.regexp_replace(reading_text(band), r"(?U)\s+", "")

    def fits(bands):
        upper, lower = bands.upper, bands.lower
        alike = F.least(tall(upper), tall(lower)) / F.greatest(tall(upper), tall(lower)) >= HEIGHTS
        same = _let(F.struct(bare(upper).alias("a"), bare(lower).alias("b")), lambda t: bigram_jaccard(t.a, t.b) >= LIKENESS)
        return (F.size(upper) >= LEAST_BAND) & (F.size(lower) >= LEAST_BAND) & alike & same

    split = lambda cut: F.struct(F.filter(words, lambda w: _middle(w) < cut).alias("upper"), F.filter(words, lambda w: _middle(w) >= cut).alias("lower"))
    return F.when(F.size(words) >= LEAST_WORDS, _let(F.array_min(counted).cut, lambda cut: F.when(cut.isNotNull(), F.when(_let(split(cut), fits), cut))))


def compared_pages(words: DataFrame, page: str, height: str | Column, headings: bool = True) -> DataFrame:
    """``page``, ``divider``, ``preamble``, ``after`` and ``before`` of the pages that hold a comparison.

    ``headings`` says whether a column of headings is looked for first. What stands right of the headings is the
    preamble, the headings themselves are dropped. The lower band ends where the upper one, mirrored at the
    divider, begins, so an article that follows the table stays out.
    """
    height = F.lit(height).cast("double") if not isinstance(height, Column) else height
    pages = page_words(words, page)
    headed = heading_place(F.col("words")) if headings else F.lit(None).cast("struct<header_x:double,divider:double>")
    found = pages.withColumn("headed", headed)
    found = found.withColumn("divider", F.coalesce("headed.divider", F.when(F.col("headed").isNull(), quiet_divider(F.col("words"), height)))).filter("divider is not null")
    edge = F.coalesce("headed.header_x", F.lit(float("inf")))
    label = lambda w: w.text.isin("改", "正", "後", "前", "改正後", "改正前") & (F.abs(w.x - edge) < HEADING_GAP)
    right = F.filter("words", lambda w: (w.x >= edge - 1.0) & ~label(w))
    upper = F.filter("words", lambda w: (w.x < edge - 1.0) & (_middle(w) < F.col("divider")))
    found = found.withColumns({"right": right, "upper": upper})
    bottom = F.coalesce(2 * F.col("divider") - F.array_min(F.transform("upper", lambda w: w.y)), F.lit(float("inf")))
    lower = F.filter("words", lambda w: (w.x < edge - 1.0) & (_middle(w) >= F.col("divider")) & (_middle(w) < bottom))
    return found.select(page, "divider", reading_text(F.col("right")).alias("preamble"), reading_text(F.col("upper")).alias("after"), reading_text(lower).alias("before"))
