"""Reading order of vertically set pages and tables from the coordinates of their words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

COLUMN_GAP, HEADING_GAP, TIER_DEPTH, TIER_WORDS, TIER_MARGIN = 10.0, 6.0, 6, 4, 0.2


def split_tiers(words: pd.DataFrame, depth: int = 0) -> list[pd.DataFrame]:
    """Horizontal tiers of a page, top first, whose words are pieces of columns.

    A tier is cut just below a piece, away from its margins, where fewest pieces are crossed (the first
    such place); if more than one is, it stays whole. A crossed piece goes to the side of its middle.
    """
    if depth >= TIER_DEPTH or len(words) < TIER_WORDS:
        return [words]
    margin = (words.y1.max() - words.y.min()) * TIER_MARGIN
    places = words.y1 + 0.5
    places = places[places.between(words.y.min() + margin, words.y1.max() - margin)]
    if places.empty:
        return [words]
    crossed = places.map(lambda y: int(((words.y < y) & (y < words.y1)).sum()))
    cut = places[crossed.idxmin()]
    above = (words.y + words.y1) / 2 < cut
    if crossed.min() > 1 or above.all() or not above.any():
        return [words]
    return split_tiers(words[above], depth + 1) + split_tiers(words[~above], depth + 1)


def columns_of(words: pd.DataFrame, gap: float = COLUMN_GAP) -> list[pd.DataFrame]:
    """Columns from the right: a word joins a column if it is close to the column's first word."""
    out: list[list] = []
    for row in words.sort_values(["x", "y"], ascending=[False, True], kind="stable").itertuples(index=False):
        if out and abs(out[-1][0].x - row.x) <= gap:
            out[-1].append(row)
        else:
            out.append([row])
    return [pd.DataFrame(c, columns=words.columns).sort_values("y", kind="stable") for c in out]


def page_text(words: pd.DataFrame) -> str:
    tiers = split_tiers(words)
    return "\n".join("\n".join("".join(c.text) for c in columns_of(t)) for t in tiers if len(t))


def heading_divider(words: pd.DataFrame) -> float | None:
    """Middle between the headings of a two-column comparison, if one column of words spells each."""
    found: dict[str, float] = {}
    for column in columns_of(words, HEADING_GAP):
        spelled = "".join(column.text)
        for heading in ("改正後", "改正前"):
            if heading in spelled and heading not in found:
                at = spelled.index(heading)
                place = 0
                spans = []
                for row in column.itertuples(index=False):
                    if place < at + len(heading) and place + len(row.text) > at:
                        spans.append((row.y, row.y1))
                    place += len(row.text)
                found[heading] = (min(s[0] for s in spans) + max(s[1] for s in spans)) / 2
    return sum(found.values()) / 2 if len(found) == 2 else None


def reading_order(words: DataFrame, page: str = "page") -> DataFrame:
    """``text`` of each page (columns ``x``, ``y``, ``y1``, ``text``): tiers, then columns, then words.

    A page is bounded, so its words meet in one group.
    """

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({page: [pdf[page].iloc[0]], "text": [page_text(pdf)]})

    return words.groupBy(page).applyInPandas(work, f"`{page}` {words.schema[page].dataType.simpleString()}, text string")


def compared_bands(words: DataFrame, page: str = "page") -> DataFrame:
    """``after`` and ``before``: texts of the bands above and below the divider of a page with headings."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        divider = heading_divider(pdf)
        if divider is None:
            return pd.DataFrame({page: [], "after": [], "before": []})
        middle = (pdf.y + pdf.y1) / 2
        return pd.DataFrame({page: [pdf[page].iloc[0]], "after": [page_text(pdf[middle < divider])], "before": [page_text(pdf[middle >= divider])]})

    return words.groupBy(page).applyInPandas(work, f"`{page}` {words.schema[page].dataType.simpleString()}, after string, before string")


def ruled_table(rules: pd.DataFrame, words: pd.DataFrame, tolerance: float = 3.0) -> list[list[str]]:
    """Cell texts of a ruled table, rows from the right; empty edges are cut."""

    def lines(values):
        out: list[list[float]] = []
        for v in sorted(values):
            if out and v - out[-1][-1] <= tolerance:
                out[-1].append(v)
            else:
                out.append([v])
        return [sum(c) / len(c) for c in out]

    xs, ys = lines(rules[rules.kind == "v"].pos), lines(rules[rules.kind == "h"].pos)
    middle = (words.y + words.y1) / 2
    grid = []
    for x0, x1 in reversed(list(zip(xs, xs[1:]))):
        strip = words[(words.x >= x0) & (words.x < x1)].sort_values(["x", "y"], ascending=[False, True])
        at = middle[strip.index]
        grid.append(["".join(strip.text[(at >= y0) & (at < y1)]) for y0, y1 in zip(ys, ys[1:])])
    while grid and not any(grid[0]):
        grid.pop(0)
    while grid and not any(grid[-1]):
        grid.pop()
    return grid


def ruled_tables(rules: DataFrame, words: DataFrame, page: str = "page") -> DataFrame:
    """``cells`` array<array<string>> of each page that has rules."""

    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({page: [], "cells": []})
        return pd.DataFrame({page: [left[page].iloc[0]], "cells": [ruled_table(left, right)]})

    return rules.groupBy(page).cogroup(words.groupBy(page)).applyInPandas(work, f"`{page}` {rules.schema[page].dataType.simpleString()}, cells array<array<string>>")
