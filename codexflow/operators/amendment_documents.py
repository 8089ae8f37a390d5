"""Amendment documents: paragraphs and comparison tables as blocks, with the ruled tables of their pages in the rows.

A document's text is cut at the headings ``改正後`` and ``改正前``; each pair of cells is cut into rows by row headings, which a longest
common subsequence aligns. Rows of a supplementary provision are moved out behind their block. Ruled tables, in the order
of pages and from the right, go to the rows that begin with ``別表``, in their order, one each and side by side: slots
and tables are numbered in their documents and joined by number.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexflow.functions.gazette import is_row_heading
from codexflow.functions.text import amendment_format
from codexflow.operators.batches import slices
from codexflow.operators.segments import joined_lines
from codexflow.operators.textdiff import common_subsequence

NEW, OLD = "改正後", "改正前"
#: Characters that begin a line of its own, and those that end a sentence.
STRUCTURAL = "^[第（別附一二三四五六七八九十イロハニホヘトチリヌルヲワカヨタレソツネ0-9０-９]"
_ENDS = r"(?U)^\s+|\s+$"
_SEGMENTS = "array<struct<heading:string,text:string>>"


def cell_text(lines: Column) -> Column:
    """Lines of a cell, trimmed, without empty ones; wrapped lines run together."""
    kept = F.filter(F.transform(lines, lambda x: F.regexp_replace(x, _ENDS, "")), lambda x: x != "")
    return F.regexp_replace(joined_lines(F.array_join(kept, "\n"), STRUCTURAL), _ENDS, "")


def segments_of(lines: Column) -> Column:
    """``heading`` and ``text`` of what a row heading begins; what stands before the first has none."""
    heads = F.transform(lines, lambda x, i: F.when(is_row_heading(x), i))
    begins = F.array_distinct(F.concat(F.array(F.lit(0)), F.array_compact(heads)))
    cut = F.transform(begins, lambda b, k: F.struct(b.alias("b"), F.coalesce(F.get(begins, k + 1), F.size(lines)).alias("e")))
    own = F.transform(cut, lambda c: F.slice(lines, c.b + 1, c.e - c.b))
    parts = F.transform(own, lambda x: F.struct(F.when(is_row_heading(F.get(x, F.lit(0))), F.regexp_replace(F.get(x, F.lit(0)), _ENDS, "")).alias("heading"), cell_text(x).alias("text")))
    return F.when(F.size(lines) > 0, F.filter(parts, lambda p: p.text != "")).otherwise(F.array().cast(_SEGMENTS))


def _aligned(blocks: DataFrame, id_col: str, least: int) -> DataFrame:
    """``rows`` array<struct<after, before>> of each block with its cells' segments; one row if a side has under ``least``
    headings or none is common. With ``least`` 0 every block is cut into rows."""
    kind = pa.list_(pa.struct([("after", pa.string()), ("before", pa.string())]))

    def rows(new, old, whole_new, whole_old):
        heads = [[s["heading"] or "" for s in side] for side in (new, old)]
        common = {h for h in heads[0]} & {h for h in heads[1]}
        if least and (min(sum(s["heading"] is not None for s in side) for side in (new, old)) < least or not common):
            return [{"after": whole_new, "before": whole_old}]
        pairs = common_subsequence(*heads)
        return [{"after": "" if i is None else new[i]["text"], "before": "" if j is None else old[j]["text"]} for i, j in pairs]

    def work(batches):
        for batch in slices(batches):
            out = [rows(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("new", "old", "whole_new", "whole_old")))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=[id_col, "block", "rows"])

    kind_ = blocks.schema[id_col].dataType.simpleString()
    return blocks.select(id_col, "block", "new", "old", "whole_new", "whole_old").mapInArrow(work, f"`{id_col}` {kind_}, block int, rows array<struct<after:string,before:string>>")


def document_rows(docs: DataFrame, id_col: str, text_col: str, least: int = 2) -> DataFrame:
    """``block``, ``kind`` (``paragraph`` or ``comparison``), ``row``, ``after``, ``before`` and ``format`` of every row of a document;
    a paragraph's text is in ``after``. Rows are ordered by ``block`` and ``row``; null texts have none. A comparison of which a
    side has under ``least`` row headings is one row."""
    lines = F.split(F.col(text_col), "\n")
    named = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col), lines.alias("lines"), amendment_format(F.col(text_col)).alias("format"))
    bare = lambda x: F.regexp_replace(x, _ENDS, "")
    news = F.array_compact(F.transform("lines", lambda x, i: F.when(bare(x) == NEW, i)))
    cuts = named.withColumn("news", news)
    first = F.coalesce(F.get("news", F.lit(0)), F.size("lines"))
    lead = cuts.select(id_col, "format", F.lit(0).alias("block"), cell_text(F.slice("lines", F.lit(1), first)).alias("after")).filter("after <> ''")
    lead = lead.select(id_col, "format", (F.col("block") * 2).alias("block"), F.lit("paragraph").alias("kind"), F.lit(0).alias("row"), "after", F.lit("").alias("before"))
    blocks = cuts.select(id_col, "format", F.posexplode("news").alias("block", "at"), F.col("news").alias("news"), F.col("lines").alias("lines"))
    stop = F.coalesce(F.get("news", F.col("block") + 1), F.size("lines"))
    blocks = blocks.select(id_col, "format", (F.col("block") + 1).alias("block"), F.slice("lines", F.col("at") + 2, stop - F.col("at") - 1).alias("own"))
    old_at = F.coalesce(F.get(F.array_compact(F.transform("own", lambda x, i: F.when(bare(x) == OLD, i))), F.lit(0)), F.size("own"))
    blocks = blocks.withColumn("old_at", old_at)
    new, old = F.slice("own", F.lit(1), F.col("old_at")), F.slice("own", F.col("old_at") + 2, F.greatest(F.size("own") - F.col("old_at") - 1, F.lit(0)))
    blocks = blocks.select(id_col, "format", "block", segments_of(new).alias("new"), segments_of(old).alias("old"), cell_text(new).alias("whole_new"), cell_text(old).alias("whole_old"))
    rows = _aligned(blocks, id_col, least).select(id_col, "block", F.posexplode("rows").alias("row", "r")).select(id_col, "block", "row", "r.after", "r.before").filter("after <> '' or before <> ''")
    apart = F.startswith("after", F.lit("附則")) | F.startswith("before", F.lit("附則"))
    rows = rows.join(named.select(id_col, "format"), id_col).withColumn("apart", apart)
    inside = rows.filter("not apart").select(id_col, "format", (F.col("block") * 2 - 1).alias("block"), F.lit("comparison").alias("kind"), "row", "after", "before")
    moved = F.when(F.col("after") != "", F.col("after")).otherwise(F.col("before"))
    behind = rows.filter("apart").select(id_col, "format", (F.col("block") * 2).alias("block"), F.lit("paragraph").alias("kind"), "row", moved.alias("after"), F.lit("").alias("before"))
    return lead.unionByName(inside).unionByName(behind)


def with_tables(rows: DataFrame, tables: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with ``after_table`` and ``before_table``: the tables (``side`` after or before, ``page``, ``place``, ``cells``) of a document
    in the rows of comparisons that begin with ``別表`` on that side; slots without a table keep null, tables without a slot go."""
    order = Window.partitionBy(id_col, "side").orderBy("page", "place")
    numbered = tables.select(id_col, "side", "cells", F.row_number().over(order).alias("slot"))
    out = rows
    for side in ("after", "before"):
        opens = (F.col("kind") == "comparison") & F.startswith(side, F.lit("別表"))
        slot = F.when(opens, F.sum(opens.cast("int")).over(Window.partitionBy(id_col).orderBy("block", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        own = numbered.filter(F.col("side") == side).select(F.col(id_col).alias("of_"), F.col("slot").alias("slot_"), F.col("cells").alias(f"{side}_table"))
        out = out.withColumn("open_", slot).join(own, (F.col(id_col) == F.col("of_")) & (F.col("open_") == F.col("slot_")), "left").drop("of_", "slot_", "open_")
    return out


def documents(rows: DataFrame, id_col: str) -> DataFrame:
    """``format`` and ``blocks`` (``kind``, ``rows``) of every document, in order."""
    cells = [c for c in ("after", "before", "after_table", "before_table") if c in rows.columns]
    part = F.when(F.col("kind") == "paragraph", F.col("row")).otherwise(0).alias("part")  # each paragraph is a block
    blocks = rows.groupBy(id_col, "format", "block", "kind", part).agg(F.array_sort(F.collect_list(F.struct("row", *cells))).alias("rows"))
    return blocks.groupBy(id_col, "format").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "kind", "rows"))), lambda b: F.struct(b.kind.alias("kind"), b.rows.alias("rows"))).alias("blocks"))


def format_counts(rows: DataFrame, id_col: str) -> DataFrame:
    """Documents of each format."""
    return rows.select(id_col, "format").distinct().groupBy("format").agg(F.count("*").alias("n"))
