"""Order-dependent operators: carried values, running segments, clusters, ranges and page lookups."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codexflow.operators.batches import slices


def carried(rows: DataFrame, group: str, order: list[str], value: Column, name: str) -> DataFrame:
    """The last value that isn't null, up to and with the row itself (captions, current issue)."""
    by = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(by))


def line_segments(docs: DataFrame, id_col: str, text_col: str, is_boundary) -> DataFrame:
    """``segment`` number, ``lines`` and ``text`` of runs of lines; a boundary line begins a new one.

    The fold runs inside the row of the document, over the array of its lines, so no line is shuffled.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    empty = F.array().cast("array<array<string>>")
    folded = F.aggregate(
        lines,
        empty,
        lambda a, x: F.when(is_boundary(x) | (F.size(a) == 0), F.concat(a, F.array(F.array(x)))).otherwise(
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.concat(F.element_at(a, -1), F.array(x))))
        ),
    )
    cut = docs.select(id_col, F.posexplode(folded).alias("segment", "parts"))
    return cut.select(id_col, "segment", F.size("parts").alias("lines"), F.array_join("parts", "\n").alias("text"))


def segment_numbers(docs: DataFrame, id_col: str, text_col: str, boundary: str) -> DataFrame:
    """Every line with its ``place`` and the running number of boundary lines up to it (``segment``)."""
    lines = docs.select(id_col, F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("place", "line"))
    by = Window.partitionBy(id_col).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("segment", F.sum(F.col("line").rlike(boundary).cast("int")).over(by))


def gap_clusters(rows: DataFrame, group: list[str], value: str, tolerance: float) -> DataFrame:
    """One row for each cluster: neighbours in order that are at most ``tolerance`` apart belong together."""
    by = Window.partitionBy(*group).orderBy(value)
    marked = rows.select(*group, value).withColumn("new_", (F.coalesce(F.col(value) - F.lag(value).over(by), F.lit(tolerance + 1)) > tolerance).cast("int"))
    numbered = marked.withColumn("cluster", F.sum("new_").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*group, "cluster").agg(F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"), F.count("*").alias("n"))


def head_clusters(values: Column, tolerance: float) -> Column:
    """Heads of clusters of a sorted array: a value opens a new one if it is too far from the cluster's head."""
    return F.aggregate(
        values,
        F.array().cast("array<double>"),
        lambda a, v: F.when((F.size(a) == 0) | (F.abs(v - F.element_at(a, -1)) > tolerance), F.concat(a, F.array(v))).otherwise(a),
    )


def cells_of_points(points: DataFrame, cells: DataFrame, page: str) -> DataFrame:
    """Points joined to the cell ``[x0, x1) x [y0, y1)`` of their page that holds them."""
    inside = (points["x"] >= cells["x0"]) & (points["x"] < cells["x1"]) & (points["y"] >= cells["y0"]) & (points["y"] < cells["y1"])
    return points.join(cells, (points[page] == cells[page]) & inside).drop(cells[page])


def cell_texts(points: DataFrame, cells: DataFrame, page: str, cell: str, text: str) -> DataFrame:
    """Text of each cell: its words by column from the right, top to bottom."""
    met = cells_of_points(points, cells, page)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("x")).alias("x"), "y", F.col(text).alias("t"))))
    return met.groupBy(page, cell).agg(F.array_join(F.transform(ordered, lambda r: r.t), "").alias("text"))


def quietest_cut(spans: DataFrame, group: str, begin: str, stop: str) -> DataFrame:
    """Of the places where a span begins the one that fewest spans cross strictly, the first of equals.

    Crossings are counted with a running sum over begins and ends (ends before begins at one place), not
    by comparing every place with every span.
    """
    marks = spans.select(F.col(group).alias("g"), F.explode(F.array(F.struct(F.col(begin).alias("at"), F.lit(1).alias("step")), F.struct(F.col(stop).alias("at"), F.lit(-1).alias("step")))).alias("m"))
    marks = marks.filter("m.at is not null").groupBy("g", F.col("m.at").alias("at")).agg(
        F.sum(F.when(F.col("m.step") == 1, 1).otherwise(0)).alias("begins"), F.sum(F.when(F.col("m.step") == -1, 1).otherwise(0)).alias("ends")
    )
    by = Window.partitionBy("g").orderBy("at")
    before = F.coalesce(F.sum(F.col("begins") - F.col("ends")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = marks.withColumn("crossings", before - F.col("ends")).filter("begins > 0")
    best = counted.groupBy("g").agg(F.min_by(F.struct("at", "crossings"), F.struct("crossings", "at")).alias("b"))
    return best.select(F.col("g").alias(group), F.col("b.at").alias("cut"), F.col("b.crossings").alias("crossings"))


def next_starts(rows: DataFrame, group: str, start: str, last: Column, most: int = 24) -> DataFrame:
    """``until``: one before the least start that is greater in the group, else ``last``; ``most`` ahead at most."""
    starts = rows.select(group, start).distinct()
    ahead = starts.withColumn("ahead", F.lead(start).over(Window.partitionBy(group).orderBy(start)))
    joined = rows.join(ahead, [group, start], "left")
    end = F.coalesce(F.col("ahead") - 1, last)
    return joined.withColumn("until", F.least(F.greatest(end, F.col(start)), F.col(start) + most)).drop("ahead")


def squeezed_lines(text: Column) -> Column:
    """Runs of blank lines become one."""
    return F.regexp_replace(text, r"\n(?:[ \t]*\n){2,}", "\n\n")


def joined_lines(text: Column, structural: str) -> Column:
    """Wrapped lines run together; a line end stays after a full stop and before a structural marker."""
    return F.aggregate(
        F.split(text, "\n"),
        F.lit(""),
        lambda a, line: F.when((a == "") | a.rlike("[。！？]$") | line.rlike(structural), F.concat(a, F.when(a == "", "").otherwise("\n"), line)).otherwise(F.concat(a, line)),
    )


def best_segment(segments: DataFrame, group: str, text: str, place: str, markers: list[str]) -> DataFrame:
    """The segment with most markers, then most characters; equal scores go to the last."""
    found = sum((F.contains(F.col(text), F.lit(m)).cast("long") for m in markers), F.lit(0).cast("long"))
    score = found * 1000 + F.length(text)
    return segments.groupBy(group).agg(F.max_by(F.struct(F.col(place), F.col(text), score.alias("score")), F.struct(score, F.col(place))).alias("s")).select(group, "s.*")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("n", "line"))


def _joined(lines: Column) -> Column:
    """Lines (structs of ``n`` and ``line``) as one text in order, without blanks at its ends."""
    return F.regexp_replace(F.array_join(F.transform(F.array_sort(lines), lambda x: x["line"]), "\n"), r"(?U)^\s+|\s+$", "")


def headed_segments(docs: DataFrame, id_col: str, text_col: str, is_heading) -> DataFrame:
    """``id``, ``segment``, ``heading`` and ``text``: what a heading begins, the heading with it; what stands before the
    first has none. Empty segments are left out."""
    by = Window.partitionBy("id").orderBy("n")
    marked = _lines(docs, id_col, text_col).withColumn("head", is_heading(F.col("line")))
    numbered = marked.withColumn("segment", F.sum(F.col("head").cast("int")).over(by))
    grouped = numbered.groupBy("id", "segment").agg(F.max(F.when(F.col("head"), F.regexp_replace("line", r"(?U)^\s+|\s+$", ""))).alias("heading"), _joined(F.collect_list(F.struct("n", "line"))).alias("text"))
    return grouped.filter("text <> ''")


#: White space as the expressions of this module have it: that of Unicode, without separators of information.
_BLANKS = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _before_and_after(text: str) -> list[tuple[int, str, str, str]]:
    """``row``, ``preamble``, ``after`` and ``before`` of one text."""
    rows: dict[int, tuple[list[str], list[str], list[str]]] = {}
    row, news, olds, old = 0, 0, 0, False
    for line in text.split("\n"):
        bare = line.strip(_BLANKS)
        if bare == "改正後":
            row, news, olds = row + 1, news + 1, 0
            continue
        old |= bare == "改正前"
        olds += bare == "改正前" and row > 0
        # Only the first of the old headings of a row is one; in the preamble none is.
        if bare in ("", "（傍線部分は改正部分）") or (bare == "改正前" and olds == 1):
            continue
        rows.setdefault(row, ([], [], []))[0 if row == 0 else 2 if olds else 1].append(line)
    return [(n, *("\n".join(part).strip(_BLANKS) for part in parts)) for n, parts in rows.items()] if news and old else []


def before_and_after(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with both headings, cut into rows: ``row`` 0 has the ``preamble``, each other what stands below one
    ``改正後`` (``after``) and below the ``改正前`` that follows it (``before``). A text is cut where it is read; no line is shuffled."""

    def work(batches):
        for batch in slices(batches):
            found = [(i, *row) for i, text in zip(*(c.to_pylist() for c in batch.columns)) for row in _before_and_after(text or "")]
            columns = list(zip(*found)) or [()] * 5
            kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "row", "preamble", "after", "before"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(work, f"id {kind}, row long, preamble string, after string, before string")
