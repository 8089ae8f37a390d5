"""Repair of conversations against a search over all edit sequences."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from codexflow.llm import turns

PATTERN = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, conv_ long, `seg_` int, times_ string, gaps int"
TEXTS = ["ok.", "cut", "", " \t", "Why?", "x ", "end! ", None, "\x1f"]
ROLES = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "author"]


def damaged(rows):
    """Rows of every conversation after damage, in order."""
    found = {}
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = [" " if x is None else x for x in (role, text)]
        mine = found.setdefault(conv, [])
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        mine += [] if fault == 0 else [(turn, role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0], r[1].encode(), r[2].encode())) for c, x in found.items()}


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        end = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        found.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[0] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows):
    """(cost, audit, repaired) by dynamic programming over (row, initials' tail), letters compared as strings."""
    marks, n = faults(rows), len(rows)
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}
    for i in range(n + 1):
        for _ in range(4):  # inserts before row i, as many as could ever pay
            for tail, (cost, audit, kept) in list(best.items()):
                for new in "ua":
                    if new in legal[tail]:
                        role = {"u": "user", "a": "assistant"}[new]
                        way = (cost + 5, audit + "I", (*kept, f"{role}:"))
                        best[new] = min(best.get(new, way), way)
        if i == n:
            break
        role, text = rows[i][1:]
        more, after = 5 * (marks[i] == "truncated"), {}
        for tail, (cost, audit, kept) in best.items():
            ways = [(tail, (cost + 2, audit + "D", kept))]
            if marks[i] not in ("blank", "duplicate"):
                if role[:1] and role[:1] in legal[tail]:
                    ways.append((role[:1], (cost + more, audit + "K", (*kept, f"{role}:{text}"))))
                for new in "ua":
                    if new in legal[tail]:
                        ways.append((new, (cost + 1 + more, audit + "R", (*kept, f"{ {'u': 'user', 'a': 'assistant'}[new] }:{text}"))))
            for new, way in ways:
                after[new] = min(after.get(new, way), way)
        best = after
    return min(way for tail, way in best.items() if tail in ("", "a"))


def report(conv, rows):
    marks = faults(rows)
    known = [t for t, _, _ in rows if t is not None]
    cost, audit, kept = cheapest(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (conv, gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def make(seed, convs=40, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for _ in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([None, rng.randint(-3, 9), rng.randint(0, 40)]), rng.choice(ROLES), rng.choice(TEXTS)))
    rows += [(1000, 1, "user", "only. " * 30000), (1001, None, None, None), (1000, 1, "user", "only. " * 30000)]
    rows += [(5000 + i, 0, "user", "gone") for i in range(60)]  # some lose all their rows
    return rows


def wide(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, "clash", 7) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("rows_, bytes_, segment", [(4096, 16 << 20, 512), (0, 0, 2), (3, 1 << 20, 3)])
def test_repair(spark, monkeypatch, rows_, bytes_, segment):
    monkeypatch.setattr(turns, "LARGE_ROWS", rows_)
    monkeypatch.setattr(turns, "LARGE_BYTES", bytes_)
    monkeypatch.setattr(turns, "SEGMENT", segment)
    rows = make(3)
    found = turns.repair(turns.damage(wide(spark, rows)), times_col="times")
    wanted = sorted((report(c, x) for c, x in damaged(rows).items()), key=repr)
    assert sorted(map(tuple, found.collect()), key=repr) == wanted
    assert {w[0] for w in wanted if w[7] == ""} > {5000 + i for i in range(60) if zlib.crc32(f"{5000 + i}:0".encode()) % 20 == 0} != set()


def test_every_edit_sequence():
    """Costs and audits are those of a search over all sequences of edits with two inserts at most in a place."""
    for picked in itertools.product([("user", "a."), ("assistant", "b"), ("system", "c."), ("tool", "d.")], repeat=3):
        rows = [(i, *p) for i, p in enumerate(picked)]
        marks = faults(rows)
        best = None
        for letters in itertools.product("DKR", repeat=3):
            for inserted in itertools.product(["", "u", "a", "ua", "au"], repeat=4):
                for roles in itertools.product("ua", repeat=letters.count("R")):
                    new, cost, audit, initials = iter(roles), 0, "", ""
                    for i in range(4):
                        initials, audit, cost = initials + inserted[i], audit + "I" * len(inserted[i]), cost + 5 * len(inserted[i])
                        if i < 3:
                            audit += letters[i]
                            if letters[i] == "D":
                                cost += 2
                            elif marks[i] in ("blank", "duplicate"):
                                cost += 1000
                            else:
                                initials += next(new) if letters[i] == "R" else rows[i][1][0]
                                cost += (letters[i] == "R") + 5 * (marks[i] == "truncated")
                    if PATTERN.match(initials) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
        assert cheapest(rows)[:2] == best


def test_distances_of_segments_agree():
    rng = random.Random(1)
    for _ in range(50):
        kinds = bytes(rng.randrange(12) for _ in range(rng.randint(0, 30)))
        cut = rng.randint(0, len(kinds))
        whole = turns.distances(kinds, turns.GOAL)
        behind = turns.distances(kinds[cut:], turns.GOAL)[:4]
        assert turns.distances(kinds[:cut], tuple(behind)) == whole[: 4 * cut + 4]
        first, state = turns.walk(kinds[:cut], whole[: 4 * cut + 4], 0, False)
        second, _ = turns.walk(kinds[cut:], whole[4 * cut :], state, True)
        assert first + second == turns.walk(kinds, whole, 0, True)[0]


def test_repaired_turns(spark, monkeypatch):
    rows = make(5, 20)
    for limit in (4096, 0):
        monkeypatch.setattr(turns, "LARGE_ROWS", limit)
        found = turns.repaired_turns(turns.damage(wide(spark, rows)), times_col="times").collect()
        left = {c: cheapest(x)[2] for c, x in damaged(rows).items()}
        assert sorted((r["conv_id"], r["place"], f"{r['role']}:{r['text']}") for r in found if r["conv_id"] is not None) == sorted((c, i, t) for c, x in left.items() for i, t in enumerate(x) if c is not None)
        assert all(r["edit"] in "KRI" for r in found)


def test_text_ids_and_empty_tables(spark):
    assert turns.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    named = spark.createDataFrame([("a", 1, "user", "x."), ("a", 2, "assistant", "y.")], "conv_id string, turn int, role string, text string")
    (row,) = turns.repair(named).collect()
    assert (row["conv_id"], row["audit"], row["cost"]) == ("a", "KK", 0)


def test_a_hot_conversation_is_solved_by_many_tasks(spark):
    rows = spark.range(30_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat("id", F.lit(".")).alias("text"))
    (row,) = turns.repair(rows).collect()
    assert row["audit"] == "KKRRRK" * 5000 and row["cost"] == 15_000
