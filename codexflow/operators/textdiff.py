"""Text alignment: edit scripts, common prefixes and suffixes, aligned headings, linked spans."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.operators.batches import slices

#: Edits beyond which no trace of frontiers is kept.
MOST_EDITS = 400
#: Bits of the vectors that are held at once, and the parts that rows with more of them are cut into.
MOST_BITS, PARTS = 1 << 26, 64
#: Masks that are held at once, those of other units are made when they are needed; and bytes from which some are made together.
MOST_MASKS, MASK_BYTES = 512, 1 << 21


def edit_script(a: Sequence[str], b: Sequence[str]) -> list[tuple[str, str]]:
    """Shortest edit script, see ``_script``."""
    return list(zip(*_script(a, b)))


def _script(a: Sequence[str], b: Sequence[str]) -> tuple[list[str], list[str]]:
    """Operations and texts of a shortest edit script; runs of one operation are joined, and of a change the deletion comes first.

    Common ends are set aside first. Of the ways that keep as many units the last units of the longer side (of the
    second, if both are equally long) are left first, so a script depends neither on the method nor on its limits.
    """
    head = _common_beginning(a, b)
    tail = _common_end(a, b, min(len(a), len(b)) - head)
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    kept = _kept(x, y) if len(x) <= len(y) else _kept(y, x)[::-1]
    i, j = (np.concatenate([np.arange(head), np.array(places[::-1], np.int64) + head, np.arange(size - tail, size)]) for places, size in zip(kept, (len(a), len(b))))
    # Where a run of kept units begins, and where the one before it has ended.
    new = np.flatnonzero(np.r_[True, (np.diff(i) != 1) | (np.diff(j) != 1)]) if len(i) else np.zeros(0, np.int64)
    starts = [[*side[new].tolist(), size] for side, size in ((i, len(a)), (j, len(b)))]
    stops = [[0, *(side[new[1:] - 1] + 1).tolist(), *(side[-1:] + 1).tolist()] for side in (i, j)]
    ops: list[str] = []
    texts: list[Sequence[str]] = []
    for from_a, to_a, from_b, to_b, stop in zip(stops[0], starts[0], stops[1], starts[1], [*stops[0][1:], 0]):
        if from_a < to_a:
            ops.append("delete")
            texts.append(a[from_a:to_a])
        if from_b < to_b:
            ops.append("insert")
            texts.append(b[from_b:to_b])
        if to_a < stop:
            ops.append("equal")
            texts.append(a[to_a:stop])
    return ops, texts if isinstance(a, str) and isinstance(b, str) else list(map("".join, texts))


def _common_beginning(a: Sequence[str], b: Sequence[str]) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _common_end(a: Sequence[str], b: Sequence[str], most: int) -> int:
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        if a[len(a) - middle : len(a) - low] == b[len(b) - middle : len(b) - low]:
            low = middle
        else:
            high = middle - 1
    return low


def joined(steps: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Steps with neighbours of one operation run together."""
    out: list[tuple[str, list[str]]] = []
    for op, unit in steps:
        if out and out[-1][0] == op:
            out[-1][1].append(unit)
        else:
            out.append((op, [unit]))
    return [(op, "".join(units)) for op, units in out]


def _kept(a: Sequence[str], b: Sequence[str]) -> tuple[list[int], list[int]]:
    """Places of a longest common subsequence in both sides, from its end; ``a`` is not longer. Frontiers are tried as
    far as they take a small share of the time of vectors."""
    if not a:
        return [], []
    most = min(MOST_EDITS, isqrt(len(a) + len(a) * len(b) // 4000))
    found = _by_frontiers(a, b, most) if len(b) - len(a) <= most else None
    return _by_vectors(a, b) if found is None else found


def _by_frontiers(a: Sequence[str], b: Sequence[str], most: int) -> tuple[list[int], list[int]] | None:
    """By greedy furthest-reaching paths, with one frontier kept for each number of edits; None beyond ``most`` edits,
    or once the way so far says that more are needed."""
    reach, trace = {1: 0}, []
    for edits in range(most + 1):
        trace.append(dict(reach))
        for k in range(-edits, edits + 1, 2):
            down = k == -edits or (k != edits and reach.get(k - 1, -1) < reach.get(k + 1, -1))
            i = reach[k + 1] if down else reach[k - 1] + 1
            while i + 32 <= len(a) and a[i : i + 32] == b[i - k : i - k + 32]:
                i += 32
            while i < len(a) and i - k < len(b) and a[i] == b[i - k]:
                i += 1
            reach[k] = i
            if i >= len(a) and i - k >= len(b):
                return _walk_back(len(a), len(b), trace)
        if edits and edits % 16 == 0 and max(2 * reach[k] - k for k in range(-edits, edits + 1, 2)) * most < (len(a) + len(b)) * edits:
            break
    return None


def _walk_back(i: int, j: int, trace: list[dict[int, int]]) -> tuple[list[int], list[int]]:
    kept: tuple[list[int], list[int]] = [], []
    edits = len(trace) - 1
    while i and j:
        reach, k = trace[edits], i - j
        if edits and reach.get(k + 1, -1) >= i:
            j, edits = j - 1, edits - 1
        elif edits and reach.get(k - 1, -1) >= i - 1:
            i, edits = i - 1, edits - 1
        else:
            i, j = i - 1, j - 1
            kept[0].append(i)
            kept[1].append(j)
    return kept


def _masks(a: Sequence[str], b: Sequence[str]) -> Callable[[str], int]:
    """The places in ``b`` of a unit of ``a`` as bits from 1 on, 0 if it has none."""
    if isinstance(a, str) and isinstance(b, str):
        number = {unit: ord(unit) for unit in set(a)}
        codes = np.frombuffer(b.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.astype(np.uint16) if codes.max(initial=0) < 1 << 16 else codes
    else:
        number = {unit: n for n, unit in enumerate(set(a))}
        codes = np.fromiter((number.get(unit, len(number)) for unit in b), np.uint32, len(b))
    order = np.argsort(codes, kind="stable")
    low, high = (np.searchsorted(codes[order], np.array(list(number.values()), np.uint32), side).tolist() for side in ("left", "right"))
    places = {unit: (x, y) for unit, x, y in zip(number, low, high)}

    def made(units: list[str]) -> list[int]:
        spans = [places[unit] for unit in units]
        bits = np.zeros((len(units), len(b) + 1), np.uint8)
        bits[np.repeat(np.arange(len(units)), [y - x for x, y in spans]), np.concatenate([order[x:y] for x, y in spans]) + 1] = 1
        return [int.from_bytes(row.tobytes(), "little") for row in np.packbits(bits, axis=1, bitorder="little")]

    units, some = list(number)[:MOST_MASKS], max(1, MASK_BYTES // (len(b) + 1))
    held = {unit: mask for n in range(0, len(units), some) for unit, mask in zip(units[n:], made(units[n : n + some]))}
    return held.__getitem__ if len(held) == len(number) else lambda unit: held[unit] if unit in held else made([unit])[0]


def _vectors(masks: Iterable[int], vector: int, full: int) -> list[int]:
    """After the mask of each unit the vector whose bit j + 1 is 0 where a longest common subsequence grows at b[j]; bit
    0 is 1, and above ``full`` there may be other bits."""
    out: list[int] = []
    hold = out.append
    n = 0
    for mask in masks:
        met = vector & mask
        if met:
            vector = (vector + met) | (vector ^ met)
            n += 1
            if not n & 63:
                vector &= full
        hold(vector)
    return out


def _last(masks: Iterable[int], vector: int, full: int) -> int:
    """The last of ``_vectors``, without holding the others."""
    for mask in masks:
        met = vector & mask
        vector = ((vector + met) | (vector ^ met)) & full
    return vector


def _by_vectors(a: Sequence[str], b: Sequence[str]) -> tuple[list[int], list[int]]:
    """By bit vectors: a unit of ``a`` takes one addition. Vectors are held for as many units as fit ``MOST_BITS``;
    of more the first of each part is, and the others are made again on the walk from the end."""
    masks = _masks(a, b)
    kept: tuple[list[int], list[int]] = [], []

    def walk(low: int, high: int, vector: int, j: int) -> int:
        full = (2 << j) - 1
        if (high - low) * j > MOST_BITS and high - low > 1:
            step = -(-(high - low) // PARTS)
            first = [vector]
            for start in range(low, high - step, step):
                first.append(_last(map(masks, a[start : start + step]), first[-1], full))
            for start in reversed(range(low, high, step)):
                if j:
                    j = walk(start, min(high, start + step), first.pop() & ((2 << j) - 1), j)
            return j
        held = [vector, *_vectors(map(masks, a[low:high]), vector, full)]
        # The last place up to j at which the subsequence grows; 0 if there is none.
        j = max((~held.pop() & full).bit_length() - 1, 0)
        i, before, keep_i, keep_j = high, held.pop, kept[0].append, kept[1].append
        while j and i > low:
            i -= 1
            vector = before()
            two = vector >> (j - 1) & 3
            if two > 1:
                j -= 1
                keep_i(i)
                keep_j(j)
                if two == 3:
                    j = max((~vector & ((2 << j) - 1)).bit_length() - 1, 0)
        return j

    walk(0, len(a), (2 << len(b)) - 1, len(b))
    return kept


def _common_lengths(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Length of a longest common subsequence of ``a`` and each beginning of ``b``, the empty one first."""
    full = (2 << len(b)) - 1
    bits = np.frombuffer(_last(map(_masks(a, b), a), full, full).to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    return np.cumsum(1 - np.unpackbits(bits, bitorder="little")[: len(b) + 1].astype(np.int64))


def text_operations(before: str, after: str) -> list[tuple[str, str]]:
    """Edit script of two texts by characters, however long they are."""
    return edit_script(before, after)


def diff_texts(pairs: DataFrame, id_col: str, before: str, after: str) -> DataFrame:
    """``ops`` array<struct<op, text>> of each pair of texts; null counts as empty."""

    def work(batches):
        for batch in slices(batches):
            sizes, ops, texts = [0], [], []
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = _script(a or "", b or "")
                ops += found[0]
                texts += found[1]
                sizes.append(len(ops))
            steps = pa.StructArray.from_arrays([pa.array(ops, pa.string()), pa.array(texts, pa.string())], ["op", "text"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), steps)], names=[id_col, "ops"])

    return pairs.select(id_col, before, after).mapInArrow(work, f"`{id_col}` {pairs.schema[id_col].dataType.simpleString()}, ops array<struct<op:string,text:string>>")


def coarse_diff(before: Column, after: Column) -> Column:
    """Struct of the common ``prefix`` and ``suffix`` sizes and the ``removed`` and ``added`` middles."""
    short = F.least(F.length(before), F.length(after))
    # The common prefix grows with its size, so its length is found by halving: 31 comparisons at most.
    step = lambda same: F.aggregate(
        F.transform(F.sequence(F.lit(30), F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int")),
        F.lit(0),
        lambda n, d: F.when((n + d <= short) & same(n + d), n + d).otherwise(n),
    )
    prefix = step(lambda n: F.left(before, n) == F.left(after, n))
    suffix = F.least(step(lambda n: F.right(before, n) == F.right(after, n)), short - prefix)
    middle = lambda t: F.substring(t, prefix + 1, F.length(t) - prefix - suffix)
    return F.struct(prefix.alias("prefix"), suffix.alias("suffix"), middle(before).alias("removed"), middle(after).alias("added"))


def common_subsequence(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    """Aligned places of two lists; where both ways are equally long, what only the first has goes first.

    By match points: ``reach[k]`` is minus the last place of ``b`` from which ``k + 1`` common units are left,
    seen from a place of ``a``. It is built from the end of ``a``; what each place changed is undone again on
    the walk from the beginning, so there is no table of all pairs of places.
    """
    where: dict[str, list[int]] = {}
    for j, unit in enumerate(b):
        where.setdefault(unit, []).append(j)
    reach: list[int] = []
    changes: list[list[tuple[int, int | None]]] = []
    for unit in reversed(a):
        changed: list[tuple[int, int | None]] = []
        for j in where.get(unit, ()):
            k = bisect_left(reach, -j)
            if k == len(reach):
                changed.append((k, None))
                reach.append(-j)
            elif reach[k] != -j:
                changed.append((k, reach[k]))
                reach[k] = -j
        changes.append(changed)
    out: list[tuple[int | None, int | None]] = []
    j = 0
    for i, unit in enumerate(a):
        left = bisect_right(reach, -j)
        for k, old in reversed(changes.pop()):
            if old is None:
                reach.pop()
            else:
                reach[k] = old
        # Without this unit as many are left: it is not needed, unless it meets its like first.
        without = bisect_right(reach, -j)
        while j < len(b) and b[j] != unit and without < left:
            out.append((None, j))
            j += 1
            without = bisect_right(reach, -j)
        if j < len(b) and b[j] == unit:
            out.append((i, j))
            j += 1
        else:
            out.append((i, None))
    return out + [(None, k) for k in range(j, len(b))]


def align_rows(rows: DataFrame, id_col: str, before: str, after: str) -> DataFrame:
    """``pairs`` array<struct<old, new>> of two arrays of headings; a single pair of all if either has
    fewer than two or they share none."""

    def work(batches):
        kind = pa.list_(pa.struct([("old", pa.string()), ("new", pa.string())]))
        for batch in slices(batches):
            out = []
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                a, b = a or [], b or []
                if len(a) < 2 or len(b) < 2 or not set(a) & set(b):
                    out.append([{"old": "\n".join(a), "new": "\n".join(b)}])
                else:
                    out.append([{"old": None if i is None else a[i], "new": None if j is None else b[j]} for i, j in common_subsequence(a, b)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=[id_col, "pairs"])

    return rows.select(id_col, before, after).mapInArrow(work, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, pairs array<struct<old:string,new:string>>")


def assign_spans(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans that don't overlap, longer ones first, in the order of the text."""
    taken: list[tuple[int, int, str]] = []
    for span in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
        if all(span[1] <= t[0] or span[0] >= t[1] for t in taken):
            taken.append(span)
    return sorted(taken)


def linked_spans(hits: DataFrame, id_col: str = "id") -> DataFrame:
    """``spans`` array<struct<begin, stop, pattern>> of each text: its hits (``begin``, ``stop``, ``pattern``), longer
    ones first, those that overlap one already taken left out, in the order of the text."""

    def work(batches):
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32()), ("pattern", pa.string())]))
        for batch in slices(batches):
            spans = [assign_spans([(h["begin"], h["stop"], h["pattern"]) for h in hits]) for hits in batch.column(1).to_pylist()]
            rows = [[{"begin": a, "stop": b, "pattern": p} for a, b, p in own] for own in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=[id_col, "spans"])

    listed = hits.groupBy(id_col).agg(F.collect_set(F.struct("begin", "stop", "pattern")).alias("hits"))
    return listed.mapInArrow(work, f"`{id_col}` {hits.schema[id_col].dataType.simpleString()}, spans array<struct<begin:int,stop:int,pattern:string>>")


#: Pairs of characters up to which a page compares texts character by character.
MOST_CELLS = 250_000


def compared_texts(pairs: DataFrame, id_col: str, before: str, after: str) -> DataFrame:
    """``ops`` of each pair as the compare page shows them: along a longest common subsequence of characters, deletions
    first; beyond ``MOST_CELLS`` pairs of characters the common beginning and end and what lies between (the
    page's own rule, by which equal stretches in the middle aren't told apart)."""

    def work(batches):
        kind = pa.list_(pa.struct([("op", pa.string()), ("text", pa.string())]))
        for batch in slices(batches):
            out = []
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                a, b = a or "", b or ""
                if len(a) * len(b) <= MOST_CELLS:
                    steps = [("equal", a[i]) if j is not None and i is not None else ("delete", a[i]) if j is None else ("insert", b[j]) for i, j in common_subsequence(list(a), list(b))]
                else:
                    head = 0
                    while head < min(len(a), len(b)) and a[head] == b[head]:
                        head += 1
                    tail = 0
                    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
                        tail += 1
                    parts = [("equal", a[:head]), ("delete", a[head : len(a) - tail]), ("insert", b[head : len(b) - tail]), ("equal", a[len(a) - tail :])]
                    steps = [(op, text) for op, text in parts if text]
                out.append([{"op": op, "text": text} for op, text in joined(steps)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=[id_col, "ops"])

    return pairs.select(id_col, before, after).mapInArrow(work, f"`{id_col}` {pairs.schema[id_col].dataType.simpleString()}, ops array<struct<op:string,text:string>>")
