"""Repair of conversations: the cheapest edits that make the roles of a conversation alternate.

A repaired conversation has the role initials ``(s?(ua)+)?``. Its rows, in order of turn (nulls first), role
and text, and the four states of that pattern (start, after system, after user, after assistant) make a
graph of (rows passed, state); keeping, re-roling or deleting a row and inserting an empty turn are its
arcs, of small integer costs. Dial's bucket queue gives the distance of every node to the end; a walk from
the start that takes the least letter among tight arcs spells the audit. No zero-cost cycle exists and no audit
is a prefix of another of the same cost, so the walk's audit is the ASCII-least of the cheapest.

A conversation of at most ``LARGE_ROWS`` rows and ``LARGE_BYTES`` is solved where it stands, in a stream sorted
by conversation. A larger one is cut into segments of ``SEGMENT`` rows over many tasks, by ranges of its
order: a segment gives its 4 x 4 distances between entering and leaving states, their min-plus
products from the last segment back give each segment the distances behind it, and then each segment walks,
in its own task again, from each of the four states it can be entered in. One task strings these letters
together and applies them to the texts as they stream by, since the digest of a conversation's text is
sequential; it holds the audit, which is one value of the result, and no texts. Rows that repeat turn,
role and text count once with their number on the way to the segments.

Defined results: a null role or text is one space; a null id is a conversation of its own; rows of a turn are
ordered by role and text; an empty role, or one of another initial, has to be re-roled or deleted; an
empty table gives no rows; a conversation whose rows are all gone gives zeros, an empty audit and the digest
of the empty string; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import stored

#: Rows and text bytes of a conversation that one task solves in memory; larger ones go by segments.
LARGE_ROWS, LARGE_BYTES = 4096, 16 << 20
#: Rows of a segment.
SEGMENT = 512
BLANKS = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
_FAR = 1 << 40
_LEGAL = {"su", "ua", "au"}
#: State after the next turn that alternation asks for, by state; states are start, after system, user, assistant.
_NEXT = (2, 2, 3, 2)


def _kept(state: int, initial: int) -> int | None:
    """State after a kept row of ``initial`` (1 system, 2 user, 3 assistant, 0 other); None if it can't stand there."""
    if initial == 1:
        return 1 if state == 0 else None
    return initial if initial and _NEXT[state] == initial else None


def _steps(kind: int) -> list[list[tuple[str, int, int, int]]]:
    """By state: (letter, cost, rows passed, state) of every arc at a row of ``kind``, in order of letters."""
    initial, fault = kind & 3, kind >> 2
    more = TRUNCATED if fault == 1 else 0
    found = []
    for state in range(4):
        arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, _NEXT[state])]
        if fault < 2:
            if _kept(state, initial) is not None:
                arcs.append(("K", more, 1, _kept(state, initial)))
            arcs.append(("R", REROLE + more, 1, _NEXT[state]))
        found.append(arcs)
    return found


#: A row's kind is its initial plus four times its fault: 0 none, 1 truncated, 2 to be deleted.
_ARCS = [_steps(kind) for kind in range(12)]
_END = [[("I", INSERT, 0, _NEXT[state])] for state in range(4)]
_BACK = [[[(s, cost) for s in range(4) for _, cost, passed, t in _ARCS[kind][s] if passed and t == to] for to in range(4)] for kind in range(12)]
_INSERTED = [[s for s in range(4) if _NEXT[s] == to] for to in range(4)]
_WIDEST = 1 + REROLE + TRUNCATED
GOAL = (0, _FAR, _FAR, 0)


def kind(initial: str, fault: int) -> int:
    return {"s": 1, "u": 2, "a": 3}.get(initial, 0) + 4 * fault


def distances(kinds: bytes, end: tuple[int, ...]) -> list[int]:
    """Cost from node 4 * (rows passed) + state to the end, where leaving by state s costs ``end[s]``."""
    n = len(kinds)
    found = [_FAR] * (4 * n + 4)
    open_ends = [v for v in end if v < _FAR]
    at, span = min(open_ends), max(open_ends) - min(open_ends) + _WIDEST
    buckets: list[list[int]] = [[] for _ in range(span)]
    waiting = 0
    for state, cost in enumerate(end):
        if cost < _FAR:
            found[4 * n + state] = cost
            buckets[cost % span].append(4 * n + state)
            waiting += 1
    while waiting:
        bucket = buckets[at % span]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if found[node] != at:
                continue
            state, base = node & 3, node & ~3
            for s in _INSERTED[state]:
                if at + INSERT < found[base + s]:
                    found[base + s] = at + INSERT
                    buckets[(at + INSERT) % span].append(base + s)
                    waiting += 1
            if base:
                for s, cost in _BACK[kinds[(base >> 2) - 1]][state]:
                    if at + cost < found[base - 4 + s]:
                        found[base - 4 + s] = at + cost
                        buckets[(at + cost) % span].append(base - 4 + s)
                        waiting += 1
        at += 1
    return found


def walk(kinds: bytes, cost: list[int], state: int, last: bool) -> tuple[str, int]:
    """Letters of the least tight arcs from ``state``, and the state they leave by; the turns inserted after
    the last row belong to the ``last`` segment."""
    n, at, letters = len(kinds), 0, []
    while at < n or (last and cost[4 * n + state]):
        here = cost[4 * at + state]
        for letter, price, passed, to in _ARCS[kinds[at]][state] if at < n else _END[state]:
            if here == price + cost[4 * (at + passed) + to]:
                letters.append(letter)
                at, state = at + passed, to
                break
        else:
            raise ValueError("no tight arc")
    return "".join(letters), state


class _Editor:
    """Applies letters to rows in order; ``turns`` takes what is left of the conversation."""

    def __init__(self, take):
        self.letters, self.at, self.state, self.take = "", 0, 0, take

    def add(self, letters: str) -> None:
        self.letters, self.at = self.letters[self.at :] + letters, 0

    def _asked(self, text: str, letter: str) -> None:
        self.state = _NEXT[self.state]
        self.take("user" if self.state == 2 else "assistant", text, letter)

    def inserts(self) -> None:
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            self._asked("", "I")

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "R":
            self._asked(text, "R")
        elif letter == "K":
            self.state = _kept(self.state, kind(role[:1], 0) & 3)
            self.take(role, text, "K")


def _fault(text: str, seen: bool) -> int:
    """0 none, 1 truncated, 2 blank, 3 duplicate."""
    end = text.rstrip(BLANKS)[-1:]
    return 2 if not end else 3 if seen else 0 if end in ".!?" else 1


_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")


class _Tally:
    """Counts over rows in order, and over stretches of rows that follow each other."""

    def __init__(self):
        self.count = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None  # initials
        self.low = self.high = None  # turns

    def _join(self, first: str, low: int | None) -> None:
        self.count["illegal"] += self.last is not None and self.last + first not in _LEGAL
        self.count["turns"] -= low is not None and low == self.high

    def row(self, turn: int | None, initial: str, fault: int) -> None:
        self._join(initial, turn)
        c = self.count
        c["rows"] += 1
        c["truncated"] += fault == 1
        c["blank"] += fault == 2
        c["duplicate"] += fault == 3
        c["turns"] += turn is not None
        self.first, self.last = initial if self.first is None else self.first, initial
        self.low, self.high = (turn if self.low is None else self.low), (self.high if turn is None else turn)

    def stretch(self, other: dict) -> None:
        self._join(other["first"], other["low"])
        for name in _COUNTS:
            self.count[name] += other[name]
        self.last = other["last"]
        self.low = other["low"] if self.low is None else self.low
        self.high = self.high if other["high"] is None else other["high"]

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.count["turns"]


_ROW = "turn_ long, role_ string, text_ string"
_PIECE = "rows long, blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, low long, high long, seg_ long"
_SOLVED = "cost long, audits array<string>, exits array<int>"


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, limit: int = 2000, limit_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, (str, bytes)))
        if len(held) >= limit or size >= limit_bytes:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _named_schema(conv: pa.DataType, fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([("conv_", conv)] + [(name, kinds[k]) for name, k in (f.split() for f in fields.split(", "))])


def _conversations(batches, emit_turns: bool) -> Iterator[dict]:
    """Reports (or the turns left) of conversations in a stream that is sorted by conversation and row; the
    pieces of a large one stand before the rows they begin with."""

    def report(conv, tally: _Tally, cost: int, audit: str, digest) -> dict:
        counts = {k: tally.count[k] for k in ("blank", "duplicate", "truncated", "illegal")}
        return {"conv_": conv, "gaps": tally.gaps(), **counts, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()}

    def group(conv, rows):
        digest, out, place = hashlib.sha256(), [], 0

        def take(role, text, letter):
            nonlocal place
            if emit_turns:
                out.append({"conv_": conv, "place": place, "role": role, "text": text, "edit": letter})
            else:
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            place += 1

        editor, tally = _Editor(take), _Tally()
        if rows[0]["seg_"] is None:  # solved here, all rows are at hand
            seen, kinds, alive = set(), bytearray(), []
            for r in rows:
                for _ in range(r["times_"]):
                    fault = _fault(r["text_"], (r["role_"], r["text_"]) in seen)
                    seen.add((r["role_"], r["text_"]))
                    tally.row(r["turn_"], r["role_"][:1], fault)
                    kinds.append(kind(r["role_"][:1], min(fault, 2)))
                    alive.append(r)
            cost = distances(bytes(kinds), GOAL)
            audit, _ = walk(bytes(kinds), cost, 0, True)
            editor.add(audit)
            for r in alive:
                editor.row(r["role_"], r["text_"])
                yield from out
                out.clear()
            editor.inserts()
            yield from out
            if not emit_turns:
                yield report(conv, tally, cost[0], audit, digest)
            return
        audits, state, total = [], 0, None
        for r in rows.rest():
            if r["seg_"] is not None:
                tally.stretch(r)
                total = r["cost"] if total is None else total
                audits.append(r["audits"][state])
                editor.add(audits[-1])
                state = r["exits"][state]
            else:
                for _ in range(r["times_"]):
                    editor.row(r["role_"], r["text_"])
            yield from out
            out.clear()
        editor.inserts()
        yield from out
        if not emit_turns:
            yield report(conv, tally, total, "".join(audits), digest)

    stream = _rows(batches)
    row = next(stream, None)
    while row is not None:
        conv, held = row["conv_"], _Held([row])
        if row["seg_"] is None:
            row = next(stream, None)
            while row is not None and row["conv_"] == conv:
                held.append(row)
                row = next(stream, None)
            yield from group(conv, held)
        else:
            after: list = []
            held.source = _same(stream, conv, after)
            yield from group(conv, held)
            row = after[0]


class _Held(list):
    """Rows of a conversation; of a large one the first, and the others as they come."""

    source: Iterator[dict] = iter(())

    def rest(self) -> Iterator[dict]:
        yield from self
        yield from self.source


def _same(stream: Iterator[dict], conv, after: list) -> Iterator[dict]:
    """Rows of ``conv``; the first of the next conversation (or None) goes to ``after``."""
    for row in stream:
        if row["conv_"] != conv:
            after.append(row)
            return
        yield row
    after.append(None)


def _cut(rows: Iterator[dict], place: int) -> Iterator[dict]:
    """Segments of sorted rows, with their counts and 4 x 4 distances; ``seg_`` follows the order of rows."""
    number = place << 40
    held: dict | None = None
    tally, kinds = _Tally(), bytearray()

    def closed():
        nonlocal number
        number += 1
        ways = [distances(bytes(kinds), tuple(0 if s == t else _FAR for s in range(4)))[:4] for t in range(4)]
        return held | tally.count | {"first": tally.first, "last": tally.last, "low": tally.low, "high": tally.high, "seg_": number, "kinds": bytes(kinds), "ways": [ways[t][s] for s in range(4) for t in range(4)]}

    for r in rows:
        for copy in range(r["times_"]):
            if held is not None and (held["conv_"] != r["conv_"] or len(kinds) >= SEGMENT):
                yield closed()
                held = None
            if held is None:
                held = {k: r[k] for k in ("conv_", "turn_", "role_", "text_")}
                tally, kinds = _Tally(), bytearray()
            fault = _fault(r["text_"], copy > 0 or not r["first_"])
            tally.row(r["turn_"], r["role_"][:1], fault)
            kinds.append(kind(r["role_"][:1], min(fault, 2)))
    if held is not None:
        yield closed()


def _behind(rows: Iterator[dict]) -> Iterator[dict]:
    """Segments, the last of a conversation first, with the distances behind each of them."""
    conv, end, begun = None, GOAL, False
    for r in rows:
        last = not begun or r["conv_"] != conv
        conv, begun, end = r["conv_"], True, GOAL if last else end
        ways = r.pop("ways")
        yield r | {"end": list(end), "final": int(last)}
        end = tuple(min(ways[4 * s + t] + end[t] for t in range(4)) for s in range(4))


def _walked(rows: Iterator[dict]) -> Iterator[dict]:
    """Letters and leaving states of each segment for every state it may be entered in."""
    for r in rows:
        kinds, end, last = r.pop("kinds"), r.pop("end"), bool(r.pop("final"))
        cost = distances(kinds, tuple(end))
        ways = [walk(kinds, cost, s, last) if cost[s] < _FAR else ("", s) for s in range(4)]
        yield r | {"cost": cost[0], "audits": [w[0] for w in ways], "exits": [w[1] for w in ways]}


def _pieces(rows: DataFrame, kind_: str) -> DataFrame:
    """The solved segments of large conversations."""
    alive = rows.groupBy("conv_", "turn_", "role_", "text_").agg(F.sum("times_").cast("long").alias("times_"))
    alive = stored(alive, "turns")
    words = F.sha2(F.concat(F.length("role_"), F.lit(":"), "role_", "text_").cast("binary"), 256)
    order = F.struct(F.col("turn_").isNotNull().alias("known"), "turn_")
    first = stored(alive.groupBy(F.col("conv_").alias("other"), words.alias("words")).agg(F.min(order).alias("least")), "first")
    marked = alive.withColumn("digest", words).join(first, (F.col("digest") == F.col("words")) & F.col("conv_").eqNullSafe(F.col("other")))
    marked = marked.select("conv_", "turn_", "role_", "text_", "times_", order.eqNullSafe(F.col("least")).alias("first_"))
    ranged = marked.repartitionByRange("conv_", "turn_", "role_", "text_").sortWithinPartitions("conv_", "turn_", "role_", "text_")
    cut_fields = f"{_ROW}, {_PIECE}, kinds binary, ways array<long>"

    def through(df: DataFrame, make, fields: str) -> DataFrame:
        def work(batches):
            held = iter(batches)
            head = next(held, None)
            if head is None:
                return
            rows = _rows(b for part in ([head], held) for b in part)
            yield from _batches(make(rows), _named_schema(head.schema.field("conv_").type, fields))

        return df.mapInArrow(work, f"conv_ {kind_}, {fields}")

    segments = stored(through(ranged, lambda rows: _cut(rows, TaskContext.get().partitionId()), cut_fields), "segments")
    backward = segments.repartition("conv_").sortWithinPartitions("conv_", F.col("seg_").desc())
    ended = through(backward, _behind, f"{_ROW}, {_PIECE}, kinds binary, end array<long>, final int")
    return through(ended.repartition("conv_", "seg_"), _walked, f"{_ROW}, {_PIECE}, {_SOLVED}")


def _plan(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, times_col: str | None, emit_turns: bool) -> DataFrame:
    kind_ = rows.schema[id_col].dataType.simpleString()
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    times = F.col(times_col).cast("long") if times_col else F.lit(1).cast("long")
    plain = rows.select(F.col(id_col).alias("conv_"), F.col(turn_col).cast("long").alias("turn_"), space(role_col).alias("role_"), space(text_col).alias("text_"), times.alias("times_"))
    sizes = plain.filter("times_ > 0").groupBy("conv_").agg(F.sum("times_").alias("rows"), F.sum(F.col("times_") * F.octet_length("text_")).alias("bytes"))
    large = stored(sizes.filter((F.col("rows") > LARGE_ROWS) | (F.col("bytes") > LARGE_BYTES)).select(F.col("conv_").alias("large_")), "large")
    nothing = f"{_PIECE}, {_SOLVED}".split(", ")
    records = plain.withColumn("text_", F.when(F.col("times_") > 0, F.col("text_")).otherwise("")).select("*", *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in nothing])
    if not large.isEmpty():
        own = plain.filter("times_ > 0").join(large, F.col("conv_").eqNullSafe(F.col("large_")), "left_semi")
        pieces = _pieces(own, kind_).withColumn("times_", F.lit(1).cast("long"))
        records = records.unionByName(pieces)
    # Rows that are gone come last, so that a large conversation begins with a piece.
    dealt = records.withColumn("late_", F.col("times_") == 0).repartition("conv_").sortWithinPartitions("conv_", "late_", "turn_", "role_", "text_", F.col("seg_").asc_nulls_last())
    fields = "place long, role string, text string, edit string" if emit_turns else "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def work(batches):
        held = iter(batches)
        head = next(held, None)
        if head is not None:
            stream = (b for part in ([head], held) for b in part)
            yield from _batches(_conversations(stream, emit_turns), _named_schema(head.schema.field("conv_").type, fields))

    return dealt.mapInArrow(work, f"conv_ {kind_}, {fields}").withColumnRenamed("conv_", id_col)


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times_col: str | None = None) -> DataFrame:
    """Per conversation: the id, ``gaps`` in its turns, rows by first fault (``blank``, ``duplicate``, ``truncated``),
    ``illegal`` neighbours, ``cost`` and ``audit`` of its repair, and the digest of the repaired text.

    ``times_col`` says how often a row stands there; a row of 0 is gone, but its conversation is reported.
    """
    return _plan(rows, id_col, turn_col, role_col, text_col, times_col, False)


def repaired_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times_col: str | None = None) -> DataFrame:
    """The turns of the repaired conversations: id, ``place`` (0, 1, ...), ``role``, ``text`` and ``edit`` (K, R or I)."""
    return _plan(rows, id_col, turn_col, role_col, text_col, times_col, True)


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults by the crc32 of ``id:turn`` modulo 20: 0 is gone, 1 has an empty text, 2 no ``.!?``,
    3 stands twice, 4 is of the user. Columns id, turn, role, text and ``times``; nulls count as one space."""
    space: Column = F.lit(" ")
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col(role_col), space), F.coalesce(F.col(text_col), space)
    return rows.select(
        F.col(id_col), F.col(turn_col),
        F.when(fault == 4, F.lit("user")).otherwise(role).alias(role_col),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias(text_col),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )
