"""Suffix-array deduplication with run-length indexes.

Removes each byte covered by a string of ``LENGTH`` bytes that also starts in a document of a smaller
id. A run-compressed Burrows-Wheeler transform of a whole corpus fits no task, so the corpus is cut
where equal strings must meet: the least hash of the 16-byte strings inside a window of ``LENGTH``
bytes is the window's minimizer, equal windows have equal minimizers, and neighbouring windows with
one minimizer form a stretch of text. The steps, all of one plan:

1. Documents are dealt out to parts by the hash of their text (one exchange of the texts, which the
   later steps reuse), so exact copies meet and only the first of them takes part in what follows.
   Each part reports the minimizers of its documents, once each.
2. A window over each minimizer, one row a part at most, keeps those that more than one document has.
3. Parts hand on their distinct stretches with a shared minimizer, each with its least id. The task
   that gets a minimizer's stretches builds a run-length index over them: run heads and starts of the
   Burrows-Wheeler transform, cumulated counts for backward steps, and documents sampled at the ends
   of runs, with the least id of every range of suffixes that agree in ``LENGTH`` bytes. Stretches
   stream through it from their ends; each step leads to a row, a row to its range, a range to the
   least id, and long matches come back as runs of windows.
4. Parts mark the bytes of the matches whose least id is below their document's.

A minimizer of more than ``HOT`` documents (a passage in much of the corpus has one at each end, with
a different neighbourhood in every document) is not gathered: parts hand on its distinct windows one
by one, and these are dealt out by their own hash, so a task gets at most one row a part for each. The same
goes for a minimizer whose stretches are as many bytes as those of so many documents: a text of short period is one long
stretch, of few distinct windows. What one minimizer brings to a task is thus bounded in bytes.

Defined results: a null text is empty; texts under ``LENGTH`` bytes lose nothing and match nothing;
rows of a null id lose nothing and match nothing; rows that repeat an id are one document, and
equal strings within a document don't count; ids are integers; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import text_bytes

LENGTH, GRAM = 50, 16
#: Documents with one minimizer from which on its windows are dealt out one by one.
HOT = 20_000
#: The longest stretch of one place of a minimizer. Documents with more than ``LONG`` such stretches each weigh more than one.
WIDEST, LONG = 2 * LENGTH - GRAM, 4
#: Copies of one text from which on they are dealt out by id, and the number of such texts at most.
COPIES, MOST_COPIED = 1000, 10_000
#: Text bytes of a part, and of the stretches that one index holds (a minimizer's stretches stay together).
PART_BYTES, INDEX_BYTES = 2 << 20, 2 << 20
_MASK = np.uint64((1 << 48) - 1)
_BASE, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def minimizers(data: np.ndarray) -> np.ndarray:
    """Of every window of ``LENGTH`` bytes the least 48-bit hash of its 16-byte strings."""
    hashed, power = data.astype(np.uint64) + np.uint64(1), int(_BASE)
    for n in (1, 2, 4, 8):
        hashed = hashed[: len(hashed) - n] * np.uint64(power) + hashed[n:]
        power = power * power % (1 << 64)
    hashed ^= hashed >> np.uint64(31)
    hashed = (hashed * _ODD) >> np.uint64(16)
    width, have = LENGTH - GRAM + 1, 1
    while have < width:
        step = min(have, width - have)
        hashed = np.minimum(hashed[: len(hashed) - step], hashed[step:])
        have += step
    return hashed & _MASK


def stretches(texts: list[bytes], wanted: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Runs of windows of one minimizer: text, first and last window, minimizer. ``wanted`` (sorted)
    leaves out all other minimizers."""
    found = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)]
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(sizes)
    if len(joined) >= LENGTH:
        least = minimizers(joined)
        begins = np.zeros(len(least) + 1, bool)
        begins[0] = True
        begins[1:-1] = least[1:] != least[:-1]
        starts = (ends - sizes)[(sizes >= LENGTH)]
        begins[starts] = True
        over = ends - LENGTH + 1  # windows from here on cross the end of their text
        begins[over[(over >= 0) & (over < len(begins)) & (sizes >= LENGTH)]] = True
        first = np.flatnonzero(begins[:-1])
        last = np.append(first[1:], len(least)) - 1
        text = np.searchsorted(ends, first, "right")
        inside = first + LENGTH <= ends[text]
        first, last, text = first[inside], last[inside], text[inside]
        value = least[first]
        if wanted is not None:
            at = np.searchsorted(wanted, value).clip(max=max(0, len(wanted) - 1))
            kept = wanted[at] == value if len(wanted) else np.zeros(len(value), bool)
            first, last, text, value = first[kept], last[kept], text[kept], value[kept]
        offset = (ends - sizes)[text]
        found.append((text, first - offset, last - offset, value))
    return tuple(np.concatenate(x) for x in zip(*found))


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of several texts, with ranges of long matches."""

    def __init__(self, texts: list[bytes], least: np.ndarray):
        """``least`` is the least document id of each text."""
        size = np.array([len(x) for x in texts], np.int64)
        self.end = np.cumsum(size + 1) - 1  # where each text's end mark stands
        joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
        joined[self.end] = 0
        self.text = joined
        n = len(joined)
        # Ranks of suffixes by their first 7 symbols, then 14, 28, ... until no two are equal.
        packed, span = np.zeros(n, np.int64), 7
        for i in range(span):
            packed[: n - i] |= joined[i:] << 9 * (span - 1 - i) if i < n else 0
        _, rank = np.unique(packed, return_inverse=True)
        half, levels = rank, [(span, rank)]
        while int(rank.max()) < n - 1:
            ahead = np.full(n, -1, np.int64)
            ahead[: max(0, n - span)] = rank[span:]
            _, rank = np.unique(rank * (n + 1) + ahead + 1, return_inverse=True)
            span *= 2
            if span < 28:
                levels.append((span, rank))
            if span == 28:
                half = rank
        if span < 28:
            half = rank  # no two suffixes agree that far
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        before = joined[order - 1]
        starts = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        heads, lengths = before[starts], np.diff(np.r_[starts, n])
        by_head = np.lexsort((starts, heads))
        self.keys = heads[by_head] << 40 | starts[by_head]
        self.run_head, self.run_start, self.run_length = heads[by_head], starts[by_head], lengths[by_head]
        total = np.cumsum(self.run_length) - self.run_length
        first = np.searchsorted(self.run_head, np.arange(258))
        self.count_before = np.append(total, n)[np.minimum(first, len(total))]  # suffixes that begin with less
        self.cumulated = total - self.count_before[self.run_head]
        # Ranges of suffixes that agree in LENGTH bytes: 28 bytes, and the 28 that end with the last of them.
        ahead = np.full(n, -1, np.int64)
        ahead[: max(0, n - (LENGTH - 28))] = half[LENGTH - 28 :]
        agree = np.stack([half[order], ahead[order]])
        self.range_start = np.flatnonzero(np.r_[True, (agree[:, 1:] != agree[:, :-1]).any(0)])
        document = np.repeat(least, size + 1)
        self.least = np.minimum.reduceat(document[order], self.range_start)
        # Where the suffixes at both ends of every run begin in the text.
        self.first_place, self.last_place = order[self.run_start], order[self.run_start + self.run_length - 1]
        self.levels = [(28, half), (28, half), *levels[::-1], *[(1, joined)] * 6]
        self.any_row = (0, int(order[0]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``a`` and ``b`` have in common, ``LENGTH`` at most."""
        n, out = len(self.text), np.zeros(len(a), np.int64)
        for span, rank in self.levels:
            x, y = a + out, b + out
            inside = np.maximum(x, y) < n
            out[inside] += span * (rank[x[inside]] == rank[y[inside]])
        return np.minimum(out, LENGTH)

    def step(self, row: np.ndarray, place: np.ndarray, size: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, place and size (``LENGTH`` at most) of the longest match after one more byte to the left."""
        runs = len(self.keys) - 1
        at = np.searchsorted(self.keys, byte << 40 | row, "right") - 1
        low, high = at.clip(0), (at + 1).clip(max=runs)
        has_low, has_high = (at >= 0) & (self.run_head[low] == byte), (at < runs) & (self.run_head[high] == byte)
        grows = has_low & (row < self.run_start[low] + self.run_length[low])
        run, offset, place, size = low.copy(), row - self.run_start[low], place.copy(), size.copy()
        jumps = np.flatnonzero(~grows & (has_low | has_high))
        if len(jumps):
            before = np.where(has_low[jumps], self.common(place[jumps], self.last_place[low[jumps]]), -1)
            behind = np.where(has_high[jumps], self.common(place[jumps], self.first_place[high[jumps]]), -1)
            up = before >= behind
            run[jumps] = np.where(up, low[jumps], high[jumps])
            offset[jumps] = np.where(up, self.run_length[low[jumps]] - 1, 0)
            place[jumps] = np.where(up, self.last_place[low[jumps]], self.first_place[high[jumps]])
            size[jumps] = np.minimum(size[jumps], np.maximum(before, behind))
        lost = ~grows & ~has_low & ~has_high  # no text has that byte
        found = ~lost
        out_row, out_place = np.full(len(row), self.any_row[0]), np.full(len(row), self.any_row[1])
        out_row[found] = (self.count_before[byte] + self.cumulated[run] + offset)[found]
        out_place[found] = place[found] - 1
        return out_row, out_place, np.where(lost, 0, np.minimum(size + 1, LENGTH))

    def match(self, patterns: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Stream patterns, which need not be of the index, through it from their ends. Yields, for one place
        after another, the patterns, the begins and the least id of those texts that hold the ``LENGTH``
        bytes from there."""
        left = np.array([len(x) for x in patterns], np.int64)
        data = np.frombuffer(b"".join(patterns), np.uint8)
        end = np.cumsum(left)
        live = np.flatnonzero(left > 0)
        row, place, size = (np.full(len(live), x, np.int64) for x in (*self.any_row, 0))
        back = 1
        while len(live):
            row, place, size = self.step(row, place, size, data[end[live] - back].astype(np.int64) + 1)
            long = size == LENGTH
            if long.any():
                yield live[long], left[live[long]] - back, self.least[np.searchsorted(self.range_start, row[long], "right") - 1]
            back += 1
            kept = left[live] >= back
            live, row, place, size = live[kept], row[kept], place[kept], size[kept]


def _digest(value: bytes) -> int:
    """64-bit digest, signed. Beside the minimizer it names a stretch within its part."""
    return xxhash.xxh3_64_intdigest(value) - (1 << 63)


def may_match(values: list[bytes]) -> np.ndarray:
    """Whether each text has a window whose 64-bit hash is that of another place too. Equal windows have
    equal hashes, so what is left out has no match."""
    size = np.array([len(v) for v in values], np.int64)
    data = np.frombuffer(b"".join(values), np.uint8).astype(np.uint64) + np.uint64(1)
    power, hashed, held, have = int(_BASE), data, None, 0
    for n in (1, 2, 4, 8, 16, 32):  # hashes of n bytes; those that make up LENGTH are put together
        if LENGTH & n:
            held = hashed if held is None else hashed[: len(held) - n] * np.uint64(pow(int(_BASE), have, 1 << 64)) + held[n : n + len(hashed)][: len(hashed[: len(held) - n])]
            have += n
        hashed = hashed[: max(0, len(hashed) - n)] * np.uint64(power) + hashed[n:]
        power = power * power % (1 << 64)
    ends = np.cumsum(size)
    first = ends - size
    many = size - LENGTH + 1
    at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
    _, back, count = np.unique(held[at], return_inverse=True, return_counts=True)
    return np.maximum.reduceat(count[back], np.cumsum(many) - many) > 1


def long_matches(keys: np.ndarray, values: list[bytes], least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, ...]:
    """For stretches with their parts' least and largest ids: stretch, first window, end, least id of all
    documents that hold those windows; only where that is below the largest.

    A key with one stretch, whatever the number of parts that have it, needs no index: all of its
    windows have the least id of all. Keys with several go into an index together.
    """
    place: dict[bytes, int] = {}
    number = np.array([place.setdefault(v, len(place)) for v in values], np.int64)
    low = np.full(len(place), np.iinfo(np.int64).max)
    np.minimum.at(low, number, least)
    size = np.array([len(v) for v in place], np.int64)
    key = np.zeros(len(place), np.int64)
    key[number] = keys
    _, back, many = np.unique(key, return_inverse=True, return_counts=True)
    alone = np.flatnonzero(many[back] == 1)
    text, begin, end, found = [alone], [np.zeros(len(alone), np.int64)], [size[alone] - LENGTH + 1], [low[alone]]
    mixed = np.flatnonzero(many[back] > 1)
    distinct = list(place)
    if len(mixed):
        # Most stretches that share a minimizer share no whole window; only those that may go on.
        likely = may_match([distinct[i] for i in mixed.tolist()])
        other = mixed[~likely]
        text, begin, end, found = text + [other], begin + [np.zeros(len(other), np.int64)], end + [size[other] - LENGTH + 1], found + [low[other]]
        mixed = mixed[likely]
    if len(mixed):
        patterns = [distinct[i] for i in mixed.tolist()]
        steps = list(RunLengthIndex(patterns, low[mixed]).match(patterns))
        t, w, f = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((w, t))
        t, w, f = t[order], w[order], f[order]
        first = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (f[1:] != f[:-1])])
        stop = np.append(first[1:], len(t)) - 1
        text, begin, end, found = text + [mixed[t[first]]], begin + [w[first]], end + [w[stop] + 1], found + [f[first]]
    text, begin, end, found = (np.concatenate(x) for x in (text, begin, end, found))
    order = np.argsort(text, kind="stable")
    text, begin, end, found = text[order], begin[order], end[order], found[order]
    # Back from distinct stretches to those of each part.
    low_at, high_at = np.searchsorted(text, number, "left"), np.searchsorted(text, number, "right")
    many = high_at - low_at
    which = np.repeat(np.arange(len(values)), many)
    at = np.repeat(low_at - (np.cumsum(many) - many), many) + np.arange(many.sum())
    kept = found[at] < most[which]
    return which[kept], begin[at[kept]], end[at[kept]], found[at[kept]]


_HANDED = "key long, m long, value binary, part long, least long, most long, hot boolean"
_MATCH = "part long, m long, digest long, begin int, stop int, least long, hot boolean"


def _match_batches(batches):
    """Matches of stretches that come sorted by key; an index holds all rows of its keys."""
    names = ("m", "part", "least", "most", "hot")

    def found(tables):
        table = pa.Table.from_batches(tables)
        value, (m, part, least, most, hot) = table.column("value").to_pylist(), (table.column(k).to_numpy() for k in names)
        which, begin, stop, low = long_matches(table.column("key").to_numpy(), value, least, most)
        digest = [_digest(value[i]) for i in which.tolist()]
        columns = [pa.array(part[which]), pa.array(m[which]), pa.array(digest, pa.int64())]
        columns += [pa.array(begin.astype(np.int32)), pa.array(stop.astype(np.int32)), pa.array(low), pa.array(hot[which].astype(bool))]
        return pa.RecordBatch.from_arrays(columns, names=["part", "m", "digest", "begin", "stop", "least", "hot"])

    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        key = batch.column("key").to_numpy()
        bounds = np.flatnonzero(np.r_[len(key) > 0 and key[0] != last, key[1:] != key[:-1]]) if len(key) else []
        weights = np.r_[0, np.cumsum([len(v) for v in batch.column("value").to_pylist()])]
        at = 0
        for cut in map(int, bounds):
            if size + weights[cut] - weights[at] >= INDEX_BYTES:
                yield found([*held, batch.slice(at, cut - at)])
                held, size, at = [], 0, cut
        if at < batch.num_rows:
            held.append(batch.slice(at))
            size += int(weights[-1] - weights[at])
            last = key[-1]
    if held:
        yield found(held)


def _usable(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Distinct texts of a part that can match, with the least id of each: the id isn't null, the text is long enough."""
    texts: dict[bytes, int] = {}
    for i, text in zip(table.column("id").to_pylist(), text_bytes(table.column("text").combine_chunks())):
        if i is not None and len(text) >= LENGTH:
            texts[text] = min(i, texts.get(text, i))
    return np.array(list(texts.values()), np.int64), list(texts)


def _report(table: pa.Table) -> pa.Table:
    """Minimizers of a part, with the number of its documents that have each, or with the number that
    its stretches' bytes stand for if that is far more."""
    ids, texts = _usable(table)
    text, first, last, value = stretches(texts)
    pair = np.unique(np.stack([value.astype(np.int64), ids[text]], 1), axis=0)
    m, docs = np.unique(pair[:, 0], return_counts=True)
    widths = np.bincount(np.searchsorted(m, value.astype(np.int64)), weights=last - first + LENGTH, minlength=len(m)).astype(np.int64) // WIDEST
    docs = np.where(widths > LONG * docs, widths, docs)
    part = pa.array(np.full(len(m), table.column("part")[0].as_py()), pa.int64())
    return pa.table([pa.array(m), part, pa.array(docs.astype(np.int64))], names=["m", "part", "docs"])


def _hand_on(key, table: pa.Table, shared: pa.Table) -> pa.Table:
    """Distinct stretches of a part with a shared minimizer; of a hot minimizer, single windows."""
    rows: dict[bytes, list] = {}
    if table.num_rows and shared.num_rows:
        hot = set(shared.filter(shared.column("hot")).column("m").to_pylist())
        ids, texts = _usable(table)
        for text, first, last, m in zip(*(x.tolist() for x in stretches(texts, np.sort(shared.column("m").to_numpy()).astype(np.uint64)))):
            doc, whole = int(ids[text]), texts[text][first : last + LENGTH]
            for value in (whole[i : i + LENGTH] for i in range(last - first + 1)) if m in hot else [whole]:
                row = rows.setdefault(value, [m, doc, doc, m in hot])
                row[1], row[2] = min(row[1], doc), max(row[2], doc)
    m, least, most, hot_ = (pa.array([r[k] for r in rows.values()], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_())))
    keys = [_digest(v) if r[3] else r[0] for v, r in rows.items()]
    part = pa.array([key[0].as_py()] * len(rows), pa.int64())
    return pa.table([pa.array(keys, pa.int64()), m, pa.array(list(rows), pa.binary()), part, least, most, hot_], names=["key", "m", "value", "part", "least", "most", "hot"])


def _mark(key, table: pa.Table, matches: pa.Table) -> pa.Table:
    """What each document of a part loses."""
    known: dict[tuple[int, int], list] = {}
    for m, digest, begin, stop, least in zip(*(matches.column(k).to_pylist() for k in ("m", "digest", "begin", "stop", "least"))):
        known.setdefault((m, digest), []).append((begin, stop, least))
    texts, ids = text_bytes(table.column("text").combine_chunks()) if table.num_rows else [], table.column("id").to_pylist()
    least_ids, distinct = _usable(table) if table.num_rows else ([], [])
    found: dict[bytes, tuple[int, list]] = {t: (int(i), []) for t, i in zip(distinct, least_ids)}
    if known:
        wanted = np.unique(matches.column("m").to_numpy()).astype(np.uint64)
        hot = set(matches.filter(matches.column("hot")).column("m").to_pylist())
        for text, first, last, m in zip(*(x.tolist() for x in stretches(distinct, wanted))):
            own, spans = found[distinct[text]]
            for at, to in ((w, w) for w in range(first, last + 1)) if m in hot else [(first, last)]:
                for begin, stop, least in known.get((m, _digest(distinct[text][at : to + LENGTH])), ()):
                    if least >= own:
                        continue
                    begin, stop = at + begin, at + stop - 1 + LENGTH
                    if spans and spans[-1][0] <= begin <= spans[-1][1]:  # neighbouring windows
                        begin, stop = spans[-1][0], max(stop, spans.pop()[1])
                    spans.append((begin, stop))
    spans = []
    for i, text in zip(ids, texts):
        least, own = found.get(text, (i, []))
        spans.append([] if i is None else own if i == least else [(0, len(text))])  # a copy in the same part goes whole
    merged = []
    for own in spans:
        out: list[list[int]] = []
        for begin, stop in sorted(own):
            if out and begin <= out[-1][1]:
                out[-1][1] = max(out[-1][1], stop)
            else:
                out.append([begin, stop])
        merged.append(out)
    kept = []
    for text, own in zip(texts, merged):
        cuts = [0, *(x for span in own for x in span), len(text)]
        kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
    return pa.table(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(x) for x in texts], pa.int64()),
            pa.array([len(x) - len(k) for x, k in zip(texts, kept)], pa.int64()),
            pa.array([len(x) for x in merged], pa.int64()),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            pa.array([[{"begin": a, "stop": b} for a, b in own] for own in merged], pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())]))),
        ],
        names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256``
    of the remaining bytes and ``spans`` (the removed runs)."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("size"), F.count("*").alias("n")).first()
    parts = max(-(-(total["size"] or 0) // PART_BYTES), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Copies meet in the part of their text. Texts with so many that a part would swell, MOST_COPIED of
    # them at most, are dealt out by id instead, and their copies meet in every part.
    text_key = F.xxhash64(F.col(text_col))
    copied = docs.groupBy(text_key.alias("text_key")).agg(F.count("*").alias("n")).filter(F.col("n") > max(COPIES, total["n"] // MOST_COPIED))
    copied = [r["text_key"] for r in copied.select("text_key").collect()]
    spread = text_key.isin(copied) if copied else F.lit(False)
    dealt = docs.select(F.pmod(F.when(spread, F.xxhash64(F.col(id_col))).otherwise(text_key), F.lit(parts)).alias("part"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    reported = dealt.groupBy("part").applyInArrow(_report, "m long, part long, docs long")
    shared = reported.withColumn("all", F.expr("sum(docs) over (partition by m)")).filter("all > 1")
    shared = shared.select("part", "m", (F.col("all") > hot).alias("hot"))
    handed = dealt.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_hand_on, _HANDED)
    matches = handed.repartition("key").sortWithinPartitions("key").mapInArrow(_match_batches, _MATCH)
    marked = dealt.groupBy("part").cogroup(matches.groupBy("part")).applyInArrow(
        _mark, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:int,stop:int>>"
    )
    return marked.withColumnRenamed("id", id_col)
