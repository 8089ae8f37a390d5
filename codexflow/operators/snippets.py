"""Snippets of matching rows as a full-text index picks them: the window of tokens that shows most of the query.

A window of ``size`` tokens is tried at every hit of a phrase, and at the beginning of the hit's sentence. A phrase that the window
shows scores 1000 the first time and 1 each time more; a window that begins a sentence has 100 more, the first of a text 120. The
first of the best wins, over all columns in their order; a window at a hit is then moved so that its hits stand in the middle.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the published algorithm.
NEW, AGAIN, SENTENCE, BEGINNING = 1000, 1, 100, 120
_BREAK = re.compile(r"[.:][ \t\n\r]+\Z")
TOKEN = re.compile(r"\w+")


def tokens(text: str) -> list[tuple[str, int, int]]:
    """(token in lower case, begin, stop) of every run of letters, digits and underscores."""
    return [(m.group().lower(), *m.span()) for m in TOKEN.finditer(text)]


def instances(words: list[str], phrases: list[list[str]]) -> list[tuple[int, int]]:
    """(place, phrase) of every place where a phrase begins, in order."""
    by_first: dict[str, list[int]] = {}
    for k, phrase in enumerate(phrases):
        by_first.setdefault(phrase[0], []).append(k)
    return [(i, k) for i, w in enumerate(words) for k in by_first.get(w, ()) if words[i : i + len(phrases[k])] == phrases[k]]


def sentences(text: str, cut: list[tuple[str, int, int]]) -> list[int]:
    """Places of the tokens that begin a sentence."""
    return [i for i, (_, begin, _) in enumerate(cut) if i == 0 or _BREAK.search(text, cut[i - 1][2], begin)]


def _window(hits: list[tuple[int, int]], places: list[int], begin: int, size: int, phrases: list[list[str]]) -> tuple[int, int, int]:
    """Score of the window from ``begin``, its first hit's place and the place behind its last hit."""
    seen, score, first, last = set(), 0, -1, 0
    for place, k in hits[bisect_left(places, begin) : bisect_left(places, begin + size)]:
        score += AGAIN if k in seen else NEW
        seen.add(k)
        first, last = (place if first < 0 else first), place + len(phrases[k])
    return score, first, last


def best_window(columns: list[str], phrases: list[list[str]], size: int) -> tuple[int, int, int] | None:
    """(column, first token, score) of the window to show; None if no column holds a phrase."""
    best, shown = 0, None
    for column, text in enumerate(columns):
        cut = tokens(text)
        hits = instances([w for w, _, _ in cut], phrases)
        places = [p for p, _ in hits]
        begins = sentences(text, cut) if hits and len(cut) > size else []
        for place, _ in hits:
            score, first, last = _window(hits, places, place, size, phrases)
            if score > best:
                best, shown = score, (column, max(min(first - (size - (last - first)) // 2, len(cut) - size), 0))
            if begins:
                begin = begins[max(bisect_right(begins, place) - 1, 0)]
                if begin < place:
                    score = _window(hits, places, begin, size, phrases)[0] + (SENTENCE if begin else BEGINNING)
                    if score > best:
                        best, shown = score, (column, begin)
    return None if shown is None else (*shown, best)


def marked(text: str, phrases: list[list[str]], begin: int = 0, size: int | None = None, marks: tuple[str, str] = ("<mark>", "</mark>"), dots: str = "...") -> str:
    """A window of ``text`` (all of it without ``size``) with its phrases in marks; phrases that overlap share one."""
    cut = tokens(text)
    stop = len(cut) if size is None else min(begin + size, len(cut))
    spans: list[list[int]] = []
    for place, k in instances([w for w, _, _ in cut], phrases):
        if place < begin or place + len(phrases[k]) > stop:
            continue
        if spans and place < spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], place + len(phrases[k]))
        else:
            spans.append([place, place + len(phrases[k])])
    at = cut[begin][1] if begin and cut else 0
    out = [dots if begin else ""]
    for a, b in spans:
        out += [text[at : cut[a][1]], marks[0], text[cut[a][1] : cut[b - 1][2]], marks[1]]
        at = cut[b - 1][2]
    whole = size is None or stop == len(cut)
    return "".join([*out, text[at:] if whole else text[at : cut[stop - 1][2]], "" if whole else dots])


def snippets(rows: DataFrame, keys: list[str], columns: list[str], phrases: list[list[str]], size: int = 8) -> DataFrame:
    """``keys``, the ``column`` shown, its ``snippet``, and ``marked``: every column whole with its marks. Rows that hold no
    phrase are left out; nulls count as empty texts; phrases are lists of tokens in lower case."""
    wanted = [p for p in phrases if p]

    def work(batches):
        for batch in batches:
            kept, names, shown, whole = [], [], [], []
            for k, texts in enumerate(zip(*(batch.column(len(keys) + i).to_pylist() for i in range(len(columns))))):
                texts = [t or "" for t in texts]
                found = best_window(texts, wanted, size)
                if found:
                    kept.append(k)
                    names.append(columns[found[0]])
                    shown.append(marked(texts[found[0]], wanted, found[1], size))
                    whole.append([marked(t, wanted) for t in texts])
            own = [batch.column(i).take(pa.array(kept, pa.int64())) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(names, pa.string()), pa.array(shown, pa.string()), pa.array(whole, pa.list_(pa.string()))], names=[*keys, "column", "snippet", "marked"])

    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys]
    narrow = rows.select(*keys, *[F.col(c).cast("string").alias(f"text{i}_") for i, c in enumerate(columns)])
    return narrow.mapInArrow(work, ", ".join([*fields, "column string, snippet string, marked array<string>"]))
