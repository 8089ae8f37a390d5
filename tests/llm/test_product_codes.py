"""Product codes against a plain form of their definition."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from codexflow.llm import product_codes

SCHEMA = "vec_id long, embedding array<float>, label int, id_ int, label_ int, ints string, code string, of int"


def wanted(rows, longest=None):
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 8)
    kept = [(i, v + [0] * (8 * width - len(v)), lab) for i, v, lab in kept]
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    parts = lambda v: [v[p * width : (p + 1) * width] for p in range(8)]
    books = [[parts(v)[p] for _, v, _ in start] for p in range(8)]

    def assign(v):
        ways = [[(sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(books[p])] for p, x in enumerate(parts(v))]
        return [min(w) for w in ways]

    for _ in range(6):
        found = [[[] for _ in books[p]] for p in range(8)]
        for _, v, _ in kept:
            for p, (_, k) in enumerate(assign(v)):
                found[p][k].append(parts(v)[p])
        for p in range(8):
            for k, x in enumerate(found[p]):
                if x:
                    books[p][k] = [sum(c) // len(x) for c in zip(*x)]
    coded = [(i, "".join(f"{k:02x}" for _, k in assign(v)), sum(d for d, _ in assign(v)), lab) for i, v, lab in kept]
    total = {}
    for _, _, error, lab in coded:
        total[lab] = total.get(lab, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, code, error, total[lab], digest) for i, code, error, lab in coded]


def make(seed, length, count):
    rng = random.Random(seed)
    number = lambda: rng.choice([rng.gauss(0, 1), rng.randint(-3, 3) / 4096, 0.0, -0.5])
    import struct

    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    rows = [(i, [single(number()) for _ in range(length)], rng.choice([None, 1, 2, 3])) for i in range(3, count)]
    rows += [(0, None, 1), (1, [0.0] * (length - 1) + [None], 1), (2, [float("nan")] * length, None), (-1, [float("inf")] + [0.0] * (length - 1), 2)]
    rows += [rows[0], rows[0], (5, [0.25] * length, 2), (None, [0.5] * length, 3), (None, [0.125] * length, None)]
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, 9, "clash", "clash", 9) for r in rows], SCHEMA).repartition(4)


def same(df, rows):
    found = df.select("vec_id", F.lower(F.hex("code")), "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(wanted(rows), key=repr)


@pytest.mark.parametrize("length, count", [(64, 120), (8, 300), (16, 12)])
def test_codes(spark, length, count):
    rows = make(length, length, count)
    same(product_codes.quantise(table(spark, rows)), rows)


def test_odd_lengths(spark):
    rows = [(i, [i / 7] * (i % 12), i % 2) for i in range(40)]
    rows = [(i, [float(math.floor(x * 64) / 64) for x in v], lab) for i, v, lab in rows]
    same(product_codes.quantise(table(spark, rows)), rows)
    same(product_codes.quantise(table(spark, [(1, [], None), (2, [], 5)])), [(1, [], None), (2, [], 5)])


def test_nothing_to_code(spark):
    assert product_codes.quantise(table(spark, [])).count() == 0
    assert product_codes.quantise(table(spark, [(1, None, 2), (2, [None], 2)])).count() == 0


def test_codes_stand_for_near_vectors(spark):
    vectors = product_codes.integer_vectors(table(spark, make(2, 64, 400)))
    shape = product_codes.Shape(64)
    books = product_codes.train(vectors, shape)
    for r in product_codes.encode(vectors, shape, books).join(vectors, "id_").filter("id_ is not null and id_ > 6").collect():
        assert ((product_codes.decode([r["code"]], books)[0] - r["ints"]) ** 2).sum() == r["error"]
