"""The pipeline's stages one after another on the smallest tables, each against its operator."""

import random

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "substring_dedup", "decontamination", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), name)
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids and docs.count() == len(now)
        assert now == ids if name in ("substring_dedup", "byte_bpe") else len(now) > 0.5 * len(ids)
        assert docs.columns == columns if name != "byte_bpe" else "token_ids" in docs.columns
        ids = now
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).collect()} == ids


def test_stages_on_odd_rows(spark):
    """Nulls, empty, blank and very long texts, repeated rows, no ``n_chars``, columns of names that operators use."""
    long = " ".join(f"w{i}" for i in range(60_000))
    texts = ["plain words of a clean text that nothing else says", None, "", " \n", "x", long, long + " more", "é" * 5000]
    rows = [(i, t, "a", 1, "p") for i, t in enumerate(texts)] + [(0, texts[0], "a", 1, "p"), (None, "said without an id", "a", 1, "p"), (None, None, None, None, None)]
    schema = "doc_id long, text string, spans string, label int, part string"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF_DIR)
        got = found.collect()
        ids = {r["doc_id"] for r in got}
        assert {0, 4, 5, 7, None} <= ids and (6 in ids) == (name != "simhash")
        if name != "byte_bpe":
            assert found.columns == docs.columns and {r["text"] for r in got if r["doc_id"] in (0, 7, None)} == {texts[0], texts[7], "said without an id", None}
        empty = stage(spark, spark.createDataFrame([], schema), SF_DIR)
        assert empty.columns == found.columns and empty.count() == 0


def test_near_copies_and_repeats_by_brute_force(spark):
    """Both stages on planted copies: groups by exhaustive comparison of shingle sets, repeats by search."""
    rng = random.Random(3)
    make = lambda n: [f"{rng.choice('abcdefgh')}{rng.randint(0, 9999)}" for _ in range(n)]
    base = [make(120) for _ in range(12)]
    texts = [" ".join(b) for b in base]
    texts += [" ".join([*b[:60], "other", *b[61:]]) for b in base[:6]]  # one word changed: similar
    texts += [" ".join([*b[:60], *make(60)]) for b in base[6:9]]  # half of it new: not similar
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies_out(spark, docs, SF_DIR).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert kept == {i for i, x in enumerate(label) if i == x} and len(kept) == 15
    passage = " ".join(make(150))  # all but a chunk (128 bytes at most) at either end goes
    planted = spark.createDataFrame([(i, f"{' '.join(make(20))} {passage} {' '.join(make(20))}") for i in range(5)], "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeats_out(spark, planted, SF_DIR).collect()}
    words = set(passage.split())
    assert passage in left[0] and all(len(words & set(left[i].split())) < 0.4 * len(words) for i in range(1, 5))
    assert all(len(left[i].split()) >= 40 for i in range(5))
