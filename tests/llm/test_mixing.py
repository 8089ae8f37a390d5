"""The mix against a plain form of its definition."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from codexflow.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, source_size int, draw int, of int, copy int, rate string, place int"


def make(seed, sources):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 1, 5, 40, 300]))), rng.choice(sources)) for i in range(400)]
    rows += [(7, None, "a"), (None, "no id here", None), (None, None, None), (8, " \t\x0b ", "b"), (9, "x " * 20000, sources[0])]
    return rows + [(5, "again with an id", "a")] * 2


def wanted(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    own = Counter()
    for _, t, s in rows:
        own[s] += size(t)
    order = sorted(own, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(own.values()), {}, set(order)
    while open_:  # the excess is shared again until none is above
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * own[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s], left = 2.0 * own[s], left - 2 * own[s]
        open_ -= full
    found = []
    for i, t, s in rows:
        draw = int(hashlib.md5(f"mix|{'' if i is None else i}|{t or ''}".encode()).hexdigest()[:13], 16) / 2**52
        rate = target[s] / own[s] if own[s] else 0.0
        found.append((i, size(t), own[s], round(target[s], 6), int(rate) + (draw < rate - int(rate))))
    return found


def wide(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 1, 1, 1, "clash", 1) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("sources", [["a", "b", "c", "é", "B", "", None], ["hot"] * 30 + [f"s{i}" for i in range(40)], [None], ["z"]])
def test_plan(spark, sources):
    rows = make(len(sources), sources)
    found = [(r[0], r[1], r[2], round(r[3], 6), r["copies"]) for r in mixing.plan_mix(wide(spark, rows)).collect()]
    assert sorted(found, key=repr) == sorted(wanted(rows), key=repr)
    again = [(r[0], r[1], r[2], round(r[3], 6), r["copies"]) for r in mixing.plan_mix(wide(spark, rows[::-1]).repartition(2)).collect()]
    assert sorted(again, key=repr) == sorted(found, key=repr)


def test_mix_emits_the_planned_copies(spark):
    rows = make(1, ["a", "b", None])
    docs = wide(spark, rows)
    emitted = mixing.mix(docs)
    assert emitted.columns == docs.columns
    assert Counter(r["doc_id"] for r in emitted.collect()) == Counter({k: v for k, v in sum((Counter({w[0]: w[4]}) for w in wanted(rows)), Counter()).items() if v})


def test_targets_are_met(spark):
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    sums = mixing.plan_mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("copies").alias("most")).collect()
    assert all(abs(r["taken"] / r["target"] - 1) < 0.02 and r["most"] <= 2 for r in sums)


def test_nothing_to_mix(spark):
    assert mixing.plan_mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r["copies"] for r in mixing.plan_mix(wide(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]


def test_mixing_runs_no_python(spark):
    plan = mixing.plan_mix(wide(spark, make(1, ["a"])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan
