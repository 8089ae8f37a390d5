"""Gazette days: amendment texts of items from their pages, and links of items to amendment events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.functions import gazette
from codexflow.functions.text import amendment_format, is_amending_title, title_core
from codexflow.operators.segments import line_segments, next_starts
from codexflow.sources.workspace import stored

MOST_PAGES, LINKED_FROM = 24, 0.80
#: Characters of the grams by which titles are looked up; a shorter title is found only if it is equal.
GRAM = 4


def names_title(text: Column, core: Column) -> Column:
    """Whether a text holds the core of a title, or its beginning: that may be cut by two characters and
    then by four again and again, but not under six. A core under four characters names nothing."""
    size = F.length(core)
    shortest = F.when(size >= 8, 6 + (size - 8) % 4).otherwise(size)
    return (size >= 4) & F.contains(text, F.left(core, shortest))


def amendment_texts(items: DataFrame, pages: DataFrame, amending_only: bool = True) -> DataFrame:
    """``amend_text`` and ``amend_format`` of each item.

    ``items`` has ``issue``, ``item``, ``title``, ``page``; ``pages`` has ``issue``, ``page``, ``text``. An
    item runs to the page before the next item's, ``MOST_PAGES`` at most; the pages' text is cut at article
    boundaries and of the segments that name the title the one that reads most like an amendment stands for
    the item; an item that none names has no row.
    """
    wanted = items.filter(is_amending_title(F.col("title"))) if amending_only else items
    last = pages.groupBy("issue").agg(F.max("page").alias("last"))
    spans = next_starts(items.join(last, "issue").select("issue", "item", "title", "page", "last"), "issue", "page", F.col("last"), MOST_PAGES)
    spans = spans.join(wanted.select("issue", "item"), ["issue", "item"], "left_semi")
    # The page on which the next item begins may hold this one's end.
    each = spans.select("issue", "item", "title", F.explode(F.sequence("page", F.least(F.col("until") + 1, F.col("last")))).alias("page"))
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    joined = each.join(pages, ["issue", "page"]).groupBy("issue", "item", "title").agg(F.array_join(F.transform(ordered, lambda p: p.text), "\n").alias("text"))
    keyed = joined.select(F.struct("issue", "item", "title").alias("key"), gazette.cleaned(F.col("text")).alias("text"))
    parts = line_segments(keyed, "key", "text", gazette.is_boundary)
    named = parts.filter(names_title(F.col("text"), title_core(F.col("key.title"))))
    best = named.groupBy("key").agg(F.max_by("text", F.struct(gazette.amending_score(F.col("text")), "segment")).alias("amend_text"))
    return best.select("key.issue", "key.item", "key.title", F.trim("amend_text").alias("amend_text"), amendment_format(F.col("amend_text")).alias("amend_format"))


def _grams(rows: DataFrame) -> DataFrame:
    """``date``, ``core`` and the distinct grams of ``GRAM`` characters of each core that has one."""
    at = F.sequence(F.lit(1), F.length("core") - (GRAM - 1))
    grams = F.array_distinct(F.transform(at, lambda i: F.substr("core", i, F.lit(GRAM))))
    return rows.filter(F.length("core") >= GRAM).select("date", "core", F.size(grams).alias("size"), F.explode(grams).alias("gram"))


def _holding(short: DataFrame, long: DataFrame) -> DataFrame:
    """``date``, ``core`` (of ``short``) and ``holder`` (of ``long``): cores of ``GRAM`` characters and more that another
    core of their date holds. A core is looked up by that of its grams which the fewest holders have."""
    held = stored(_grams(long).select("date", "gram", F.col("core").alias("holder")), "grams")  # so that Spark can split a frequent gram
    counts = held.groupBy("date", "gram").agg(F.count("*").alias("n"))
    met = _grams(short).join(counts, ["date", "gram"]).groupBy("date", "core").agg(F.count("*").alias("found"), F.max("size").alias("size"), F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    anchors = stored(met.filter("found = size").select("date", "core", "gram"), "anchors")
    return anchors.join(held, ["date", "gram"]).filter(F.contains("holder", F.col("core")) & (F.col("holder") != F.col("core"))).select("date", "core", "holder")


def item_matches(events: DataFrame, items: DataFrame, longer_items: bool = True) -> DataFrame:
    """Best item of each event by equal dates and the cores of their titles.

    ``events`` has ``event``, ``date``, ``title``; ``items`` has ``date``, ``issue``, ``item``, ``title``. The
    confidence is a half and 0.45 of the title's score (``linking.title_score``); equal ones go to the first issue and item.
    Null dates and titles match nothing. Without ``longer_items`` an item's core may be held by the event's, but not hold it.

    A date's titles aren't paired: equal ones are one row, of which the first item counts, and one that holds
    another is found by a gram of the other.
    """
    left = stored(events.select("event", "date", title_core(F.col("title")).alias("core")).filter("date is not null and core is not null"), "events")
    titled = items.select("date", title_core(F.col("title")).alias("core"), F.struct("issue", "item").alias("place"), F.col("title").alias("item_title")).filter("core is not null")
    first = stored(titled.groupBy("date", "core").agg(F.min("place").alias("place"), F.min_by("item_title", "place").alias("item_title")), "first-items")
    asked, known = left.select("date", "core").distinct(), first.select("date", "core")
    ours = F.col("core").alias("item_core")
    pairs = asked.join(known, ["date", "core"]).select("date", "core", ours, F.lit(1.0).alias("score"))
    pairs = pairs.union(_holding(known, asked).select("date", F.col("holder").alias("core"), ours, F.lit(0.8)))
    if longer_items:
        pairs = pairs.union(_holding(asked, known).select("date", "core", F.col("holder").alias("item_core"), F.lit(0.8)))
    scored = pairs.join(first.withColumnRenamed("core", "item_core"), ["date", "item_core"])
    best = scored.groupBy("date", "core").agg(F.min_by(F.struct("score", "place", "item_title"), F.struct(-F.col("score"), F.col("place"))).alias("b"))
    best = stored(best, "best-items")
    return left.join(best, ["date", "core"]).select("event", F.round(0.5 + 0.45 * F.col("b.score"), 4).alias("confidence"), "b.place.issue", "b.place.item", "b.item_title")


def linked_events(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Events with a ``kanpo`` struct, linked from a confidence of ``LINKED_FROM`` on; null without a match."""
    joined = events.join(matches, "event", "left")
    link = F.struct((F.col("confidence") >= LINKED_FROM).alias("linked"), "confidence", "issue", "item", "item_title")
    return joined.withColumn("kanpo", F.when(F.col("confidence").isNotNull(), link)).drop("confidence", "issue", "item", "item_title")
