"""Ruled tables of a page, several beside each other, as grids of cell texts.

Rules of one table begin at about the same place; tables, lines and columns are islands of values with small gaps, found by
windows over a page's rules. Words meet only the cells of their own page and table. The setting is vertical: a column of
the page, from the right, is a row of the table, and the bands from the top are its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexflow.operators.segments import gap_clusters

#: Gaps within a table's beginnings and within a line, how far rules stand out of a band, and the longest rule of a cell.
START_GAP, LINE_GAP, ABOVE, BELOW, LONGEST = 12.0, 4.0, 2.0, 12.0, 300.0


def _lanes(lines: DataFrame, keys: list[str], a: str, b: str, place: str) -> DataFrame:
    """Neighbouring lines (``mean``) as lanes from ``a`` to ``b``, numbered by ``place``."""
    by = Window.partitionBy(*keys).orderBy("mean")
    return lines.select(*keys, F.col("mean").alias(a), F.lead("mean").over(by).alias(b), (F.row_number().over(by) - 1).alias(place)).filter(F.col(b).isNotNull())


def page_tables(rules: DataFrame, words: DataFrame, bands: DataFrame, page: str = "page", band: str = "band") -> DataFrame:
    """``page``, ``band``, ``place`` (0, 1, ... from the right), ``left_x`` and ``cells`` array<array<string>> of every table.

    ``rules`` has ``kind`` (h: at ``pos`` from ``low`` to ``high`` of x; v: at ``pos`` of x from ``low`` to ``high``), ``words`` has ``x``, ``y``,
    ``y1`` and ``text``, ``bands`` the ``y0`` and ``y1`` of each band and ``most_x``, beyond which nothing is a table. Rows and
    columns that are empty at the edges are cut; a table without any text is none.
    """
    keys = [page, band, "table"]
    bands = bands.select(page, band, F.col("y0").alias("top"), F.col("y1").alias("bottom"), "most_x")
    flat = rules.filter("kind = 'h'").join(bands, page).filter((F.col("top") - ABOVE <= F.col("pos")) & (F.col("pos") <= F.col("bottom") + BELOW) & (F.col("high") <= F.col("most_x")) & (F.col("high") - F.col("low") <= LONGEST))
    starts = gap_clusters(flat, [page, band], "low", START_GAP).select(page, band, F.col("cluster").alias("table"), "mean")
    own = flat.join(starts, [page, band]).filter(F.abs(F.col("low") - F.col("mean")) <= START_GAP)
    extent = own.groupBy(*keys).agg(F.min("low").alias("left_x"), F.max("high").alias("right_x"), F.count("*").alias("n"), F.first("top").alias("top"), F.first("bottom").alias("bottom")).filter("n >= 2")
    upright = rules.filter("kind = 'v'").select(page, F.col("pos").alias("x_"), F.col("low").alias("low_"), F.col("high").alias("high_"))
    upright = upright.join(extent, page).filter((F.col("low_") <= F.col("bottom") + BELOW) & (F.col("high_") >= F.col("top") - ABOVE) & F.col("x_").between(F.col("left_x") - ABOVE, F.col("right_x") + ABOVE))
    rows = _lanes(gap_clusters(upright, keys, "x_", LINE_GAP), keys, "x0", "x1", "column")
    lanes = _lanes(gap_clusters(own.join(extent.select(*keys), keys, "left_semi"), keys, "pos", LINE_GAP), keys, "y0", "y1", "lane")
    # The columns of the page, from the right, are the rows of the table.
    many = Window.partitionBy(*keys)
    cells = rows.withColumn("row", F.max("column").over(many) - F.col("column")).join(lanes, keys)
    placed = words.select(page, "x", ((F.col("y") + F.col("y1")) / 2).alias("yc"), "text")
    inside = (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("yc") >= F.col("y0")) & (F.col("yc") < F.col("y1"))
    met = placed.join(cells, page).filter(inside)
    said = met.groupBy(*keys, "row", "lane").agg(F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("x")).alias("k"), "yc", "text"))), lambda w: w.text), "")).alias("text"))
    said = said.filter("text <> ''")
    edges = said.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for c in ("row", "lane") for n, f in (("first", F.min), ("last", F.max))])
    full = cells.select(*keys, "row", "lane").join(edges, keys).filter("row between first_row and last_row and lane between first_lane and last_lane")
    full = full.join(said, [*keys, "row", "lane"], "left").withColumn("text", F.coalesce("text", F.lit("")))
    lines = full.groupBy(*keys, "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("lane", "text"))), lambda c: c.text).alias("line"))
    tables = lines.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda r: r.line).alias("cells"))
    tables = tables.join(extent.select(*keys, "left_x"), keys)
    by = Window.partitionBy(page, band).orderBy(F.col("left_x").desc(), "table")
    return tables.select(page, band, (F.row_number().over(by) - 1).alias("place"), "left_x", "cells")
