"""The pipeline's near-copy stage against brute force over five-word shingles."""

import random

import corpus_pipeline
import pytest

from codexflow.llm import nearcopies


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


@pytest.mark.parametrize("part", [500, 6])
def test_stage_drops_planted_near_copies(spark, monkeypatch, part):
    monkeypatch.setattr(nearcopies, "PART", part)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(100, 300))]
        rows.append(" ".join(base))
        for edits in (1, 2, 3, 4, 5, 6, 9, 14):  # a replaced word takes five shingles
            copy = list(base)
            for at in rng.sample(range(len(base)), edits):
                copy[at] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += [" ".join(rng.choice(words) for _ in range(60)) for _ in range(30)] + ["few words", "few words", "few other words", "", None, rows[0].upper()]
    rng.shuffle(rows)
    sets = [shingles(t) for t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and alike(sets[a], sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    wanted = {min(i for i, g in enumerate(group) if g == own) for own in group}
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)] + [(None, rows[0], "x")], "doc_id long, text string, lang string")
    kept = corpus_pipeline.near_copies_out(spark, df.repartition(3), "")
    assert kept.columns == df.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == [-1, *sorted(wanted)]


def test_links_are_similar_and_complete():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(150)]
    found = nearcopies.link_sets(sets, 0.4)
    plain = [set(s.tolist()) for s in sets]
    pairs = [(a, b) for a in range(150) for b in range(a) if plain[a] and plain[b] and len(plain[a] & plain[b]) >= 0.4 * len(plain[a] | plain[b])]
    assert pairs and all((max(p), min(p)) in pairs for p in found)

    def joined(links):
        label = list(range(150))
        for a, b in links:
            label = [label[b] if x == label[a] else x for x in label]
        return {frozenset(i for i, x in enumerate(label) if x == own) for own in label}

    assert joined(found) == joined(pairs)


def test_chains_cost_in_proportion(spark, monkeypatch):
    """Of documents that only share shingles with their neighbours none is set against the whole chain: rows grow
    like the chain. At ten new words of 104 neighbours have a similarity of 90/110, the next but one of 80/120."""
    monkeypatch.setattr(nearcopies, "PART", 10)
    rows = {}
    for n in (50, 250):
        texts = [" ".join(f"w{k}" for k in range(i * 10, i * 10 + 104)) for i in range(n)]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        nodes = nearcopies.mark_documents(df, 5, "doc_id", "text").cache()
        heads = nearcopies.key_heads(nodes).cache()
        links = nearcopies.similar_links(df, nodes.withColumnRenamed("doc_id", "least"), 5, 0.8, "doc_id", "text").cache()
        number = {r["node"]: r["doc_id"] for r in nodes.collect()}
        found = {tuple(sorted((number[r["a"]], number[r["b"]]))) for r in links.collect()}
        assert all(b - a == 1 for a, b in found) and len(found) >= 0.97 * (n - 1)  # a pair has a key with probability 0.998
        rows[n] = nearcopies.star_places(heads).count() + nearcopies.open_blocks(heads, links).count()
    assert rows[250] < 6 * rows[50] and rows[250] < 25 * 250


def test_members_that_only_other_members_join(spark, monkeypatch):
    """Groups that their heads leave in several components are finished by blocks."""
    monkeypatch.setattr(nearcopies, "PART", 4)
    rng = random.Random(5)
    base = [f"b{k}" for k in range(300)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for at in rng.sample(range(300), rng.choice([3, 8, 9, 10, 16])):
            copy[at] = f"x{rng.random()}"
        texts.append(" ".join(copy))
    sets = [shingles(t) for t in texts]
    group = list(range(60))
    for a in range(60):
        for b in range(a):
            if group[a] != group[b] and alike(sets[a], sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in nearcopies.drop_near_copies(df).collect()) == sorted({group.index(g) for g in group})


def test_codes_of_three_bits_propose(spark):
    """SimHash alone: nodes that have no other key in common are linked if their codes are close and their sets similar."""
    from pyspark.sql import functions as F

    rng = random.Random(11)
    base = [f"w{rng.randrange(9000)}" for _ in range(3000)]
    copy, other = list(base), [f"w{rng.randrange(9000)}" for _ in range(300)]
    copy[-1] = "changed"
    df = spark.createDataFrame([(0, " ".join(base)), (1, " ".join(copy)), (2, " ".join(other))], "doc_id long, text string")
    marked = nearcopies.mark_documents(df, 5, "doc_id", "text").withColumnRenamed("doc_id", "least").withColumn("keys", F.array("node")).cache()
    node = {r["least"]: r["node"] for r in marked.collect()}
    linked = nearcopies.similar_links(df, nearcopies.with_code_keys(marked), 5, 0.8, "doc_id", "text").collect()
    assert {frozenset(r) for r in linked} == {frozenset((node[0], node[1]))}
    assert nearcopies.similar_links(df, marked, 5, 0.8, "doc_id", "text").count() == 0
