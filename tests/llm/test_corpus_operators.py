"""The corpus operators against brute force, on fixtures with nulls, empty and long texts, ties and repeats."""

import base64
import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from codexflow.llm import bpe, cdc, decontam, langid, media, orc_tokens, rindex, simhash, toxicity, warc
from codexflow.llm.components import connected_components

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_ string, id_ string, part string, `hit_id` int"


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def corpus(seed=0, count=60):
    """Generated texts with copies, near copies, a shared passage, nulls, empty and long texts."""
    rng = random.Random(seed)
    words = ["the", "of", "Haus", "être", "niño", "über", "x1", "don't", "a,b", "日本", "\U0001f600"] + ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = make(70)
    texts = [make(rng.randint(0, 120)) for _ in range(count)]
    texts += [texts[3], texts[3], texts[3] + " end", f"{make(5)} {passage} {make(9)}", f"{make(30)}\n{passage}", passage, passage.upper()]
    texts += [None, "", " \t\n", "a", "ab " * 3000, "a" * 5000, "a" * 5001, "\0" * 100, "é" * 80, "<|endoftext|> \x1c  x"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(2, "again with an id"), (2, "again with an id"), (None, passage), (None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "clash", "clash", "clash", 1) for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, wanted):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(wanted, key=repr)


def test_byte_bpe(docs, rows, nothing):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [library.encode_ordinary(t or "") for _, t in rows]
    wanted = [(i, x, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for (i, t), x in zip(rows, ids)]
    coded = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    same(coded, wanted)
    same(bpe.decode_documents(coded, RANKS, public_tokenizers.PATTERN), [(i, bytearray((t or "").encode())) for i, t in rows])
    assert bpe.encode_documents(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_pieces_merge_alike():
    found = bpe.codec(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(4)
    for _ in range(20):
        raw = "".join(rng.choice("abinthe") for _ in range(rng.randint(2, 900))).encode()
        (matrix,) = found._merge_matrix([raw], 1024)
        assert matrix == found._merge_by_heap(raw)


def test_orc_tokens(spark, docs, rows, nothing, tmp_path):
    library = Tokenizer.from_file(WORDS)
    count = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        count.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = orc_tokens.round_trip(docs, WORDS, 2).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found), key=repr) == sorted(((i, n, c) for i, own in count.items() for n, c in own), key=repr)
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert ids == sorted(ids)
    assert orc_tokens.round_trip(nothing, WORDS, 2).count() == 0
    path = str(tmp_path / "orc")
    orc_tokens.write_tokens(docs, path, WORDS, 2)
    one = orc_tokens.read_tokens(spark, path).filter("doc_id = 7")
    assert "EqualTo(doc_id,7)" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1


def test_media(docs, rows, nothing):
    found = media.fingerprint_media(media.encode_media(docs), keep=("n_bytes",)).collect()
    texts = {}
    for i, t in rows:
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        texts.setdefault(i, set()).add((len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])))
    features = {}
    for r in found:
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) in texts[r["doc_id"]]
        assert r["media_bytes"] == r["payload_bytes"] + 44 and len(r["times"]) == len(r["codes"]) == int(r["feature"].split(":")[0])
        assert features.setdefault(r["payload_sha256"], r["feature"]) == r["feature"]
    assert len(found) == len(rows) and any(r["codes"] for r in found)
    assert media.encode_media(nothing).count() == 0
    broken = docs.limit(1).select("doc_id", F.lit(b"RIFF").alias("media"))
    assert media.fingerprint_media(broken).first()["feature"] is None


def test_peaks_of_a_tone():
    t = np.arange(5760)
    tone = (128 + 80 * np.sin(2 * np.pi * t * 20 / media.FRAME)).astype(np.uint8)
    times, bins = media.peaks(tone)
    assert set(bins[np.r_[True, times[1:] != times[:-1]]].tolist()) == {20}
    pair_times, codes = media.peak_pairs(np.array([0, 1, 1, 5]), np.array([3, 4, 5, 6]))
    assert pair_times.tolist() == [0, 0] and codes.tolist() == [3 << 10 | 4 << 2 | 1, 3 << 10 | 5 << 2 | 1]


ITEMS = [(1, "Foo, BAR"), (2, ""), (3, None), (4, "foo bar"), (5, "the of")]


@pytest.mark.parametrize("broadcast", [300_000, 0])
def test_decontamination(spark, docs, rows, nothing, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", broadcast)
    passage = next(t for i, t in rows if i == 65)
    items = spark.createDataFrame([*ITEMS, (6, passage), (7, passage)], "item_id long, text string")
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = {}
    for r in items.collect():
        w = pattern.findall(lower(r["text"] or ""))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(r["item_id"]))
    wanted = []
    for i, t in rows:
        w, hit, ids = pattern.findall(lower(t or "")), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    ids |= windows[tuple(w[k : k + n])]
        wanted.append((i, len(w), len(hit), sorted(ids)))
    found = decontam.find_hits(docs, items)
    same(found.drop("spans"), wanted)
    bad = {i for i, _, n, _ in wanted if n}
    same(decontam.drop_documents(docs, items).select("doc_id"), [(i,) for i, _ in rows if i not in bad])
    assert decontam.drop_documents(docs, items).columns == docs.columns
    again = decontam.find_hits(decontam.drop_spans(docs.filter("doc_id is not null"), items), items).filter("n_hit > 0")
    assert all(len(r["item_ids"]) and "6" not in r["item_ids"] for r in again.collect())
    assert decontam.find_hits(nothing, items).count() == 0
    assert decontam.find_hits(docs, items.limit(0)).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("broadcast", [300_000, 0])
def test_decontamination_runs_no_python(spark, docs, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", broadcast)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontam.find_hits(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def shuffled(spark, df):
    """Bytes that the stages of a run of ``df`` write for shuffles."""
    context, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway

    def written():
        context.listenerBus().waitUntilEmpty()
        stages = context.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = written()
    df.write.format("noop").mode("overwrite").save()
    return written() - before


def test_decontamination_shuffles_in_proportion_to_long_texts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 1)
    items = spark.createDataFrame([(i, " ".join(f"v{i}x{k}" for k in range(12))) for i in range(5)], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = lambda n: F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.hex(F.xxhash64(i, "id"))), " ")
    short, long = (shuffled(spark, decontam.find_hits(spark.range(40).select(F.col("id").alias("doc_id"), text(n).alias("text")), items)) for n in (1000, 10_000))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert short < long < 15 * short


def test_a_hot_chunk_is_split(spark):
    """Most chunks have one digest: the final plan splits its rows."""
    passage = F.lit("".join(f"line {k} of a passage that all documents share. " for k in range(40)))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("x" * 3000), F.hex(F.xxhash64("id")), passage).alias("text")).repartition(8)
    hot = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k) for k in hot}
    for k, v in hot.items():
        spark.conf.set(k, v)
    try:
        found = cdc.repeated_spans(docs)
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_simhash(docs, rows, nothing):
    prints = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", lower(t or ""))
        shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] != group[b]:
                old = group[a]
                group = [group[b] if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    wanted = [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, group)]
    same(simhash.near_duplicates(docs), wanted)
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    same(kept.select("doc_id"), [(i,) for i, _, c in wanted if i is None or i == c])
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("shard", [2000, 7])
def test_links_of_crowded_codes(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    rng = random.Random(shard)
    base = [rng.getrandbits(64) for _ in range(6)]
    codes = {b ^ (1 << rng.randrange(14)) ^ (1 << rng.randrange(14)) ^ (1 << rng.randrange(64)) for b in base for _ in range(25)}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "code long")
    label = {r["node"]: r["label"] for r in connected_components(simhash.near_links(df)).collect()}
    mask = (1 << 64) - 1
    parent = {c: c for c in signed}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for a in signed:
        for b in signed:
            if ((a ^ b) & mask).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {c: label.get(c, c) for c in signed} == {c: root(c) for c in signed}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 1), (100, 102)]
    found = connected_components(spark.createDataFrame(chain, "a long, b long"))
    assert {r["node"]: r["label"] for r in found.collect()} == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chunk_dedup(spark, nothing):
    rng = random.Random(9)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passages = [make(55) for _ in range(20)]
    rows = [(i, f"{make(rng.randint(0, 90))} {passages[i % 20]} {make(rng.randint(0, 90))}") for i in range(100)]
    clean = [(1000 + i, make(150)) for i in range(30)]
    odd = [(2000, None), (2001, ""), (None, passages[0]), (5, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, t, "en", "s", 0, "c", "c", "c", 1) for i, t in rows + clean + odd], SCHEMA).repartition(4)
    found = cdc.removal_report(df).collect()
    assert len(found) == len(rows + clean + odd)
    lost = {r["doc_id"]: r["n_removed"] for r in found}
    assert all(lost[i] == 0 for i, _ in clean) and all(lost[i] == 0 for i in range(20)) and lost[None] == 0
    assert all(lost[i] > 0.5 * len(passages[i % 20].encode()) for i in range(20, 100))
    texts = {}
    for i, t in rows + clean + odd:
        texts.setdefault(i, t)
    out = cdc.deduplicate(df)
    assert out.columns == df.columns
    kept = sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in out.collect())
    assert kept == sorted(r["kept_sha256"] for r in found)
    assert cdc.removal_report(nothing).count() == 0 and cdc.deduplicate(nothing).count() == 0


def test_chunks_withstand_shifts_and_keep_characters():
    rng = random.Random(1)
    text = "".join(rng.choice("abc déø日 ") for _ in range(3000)).encode()
    cut = lambda b: cdc._cut([b])
    joined, _, begin, size = cut(text)
    assert begin[0] == 0 and size.sum() == len(text) and size.max() <= cdc.MOST + 3
    one = {text[b : b + s] for b, s in zip(begin, size)}
    moved = "éé ".encode() + text
    _, _, begin, size = cut(moved)
    assert len(one & {moved[b : b + s] for b, s in zip(begin, size)}) >= len(one) - 3
    assert all((x := text[b : b + s]).decode() for b, s in zip(*cut(text)[2:]))


def test_toxicity(spark, nothing):
    rng = random.Random(2)
    syllables = ["an", "the", "er", "ing", "on", "st", "re", "nd", "ti", "ha"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    text = lambda bad: " ".join(("grumblefink" if bad and rng.random() < 0.05 else word()) for _ in range(80)) + (" grumblefink" if bad else "")
    rows = [(i, text(i % 4 == 0), i % 4 == 0) for i in range(400)]
    df = spark.createDataFrame([(i, t, "en", "s", 0, "c", "c", "c", 1) for i, t, _ in rows] + [(9000, None, None, None, None, None, None, None, None), (9001, "", *[None] * 7)], SCHEMA)
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(None, 1), (9000, None)], "doc_id long, toxic int")
    model = toxicity.train(df, labels)
    found = {r["doc_id"]: r for r in toxicity.score_documents(df, model).collect()}
    assert len(found) == 402 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [(i, y) for i, _, y in rows if found[i]["held_out"]]
    assert sum(found[i]["predicted"] == y for i, y in held) >= 0.95 * len(held)
    assert found[9000]["predicted"] == found[9001]["predicted"] == 0
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r["predicted"] == 0 for r in found.values())
    blank = toxicity.train(df, labels.limit(0))
    assert {r["score"] for r in toxicity.score_documents(df, blank).collect()} == {0.0}
    assert toxicity.score_documents(nothing, model).count() == 0


def test_toxicity_in_every_language(spark):
    """Labels of sf0.1, most of them English: held-out toxic documents are found in the other languages too."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    known = docs.join(labels.filter("toxic is not null").groupBy("doc_id").agg({"toxic": "max"}).toDF("doc_id", "toxic"), "doc_id").filter("crc32(cast(string(doc_id) as binary)) % 5 = 0")
    rows = known.select("lang", "toxic", "text").collect()
    found = [(r["lang"] == "en", r["toxic"], s >= 0.5) for r, s in zip(rows, model.score([r["text"] for r in rows]))]
    for english in (True, False):
        caught = [hit for own, y, hit in found if own == english and y]
        false = [hit for own, y, hit in found if own == english and not y]
        assert len(caught) > 30 and sum(caught) >= 0.7 * len(caught) and sum(false) <= 0.05 * len(false)


def test_language(spark, nothing, monkeypatch):
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(sf)
    found = langid.predict_documents(sf, model).join(sf.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) > 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    odd = spark.createDataFrame([(1, None), (2, "123 !?"), (3, ""), (None, "the and of with")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict_documents(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[None][0] == "en"
    assert langid.train(nothing).languages == []
    # More languages than the sample has rows: one row of each at least; ties and repeated rows train once each.
    many = spark.createDataFrame([(i, "common words " + chr(97 + i % 26) * 5 + chr(97 + i // 26 % 26) * 5, f"l{i % 90}") for i in range(500)] * 2, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 60)
    assert len(langid.train(many).languages) == 90
    assert langid.predict_documents(odd, langid.train(nothing)).filter("lang_pred <> 'und'").count() == 0


@pytest.mark.parametrize("compression, split", [("gzip", 128 << 20), ("none", 20_000), ("none", 700)])
def test_warc(spark, tmp_path, compression, split):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 19\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\r\n\r\n"
    rng = random.Random(1)
    pages = [(i, "u", rng.choice(["x", inner * 20, "WARC/1.0\r\n", "WARC/1.", inner + "z" * 5000 + "é", None, "", "p" * 30_000])) for i in range(60)]
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(1 if split == 20_000 else 2), path, compression=compression)
    if compression == "none":
        placed = spark.read.option("lineSep", warc.MAGIC).text(path).select("_metadata.file_size").distinct()
        assert all(r[0] > 3 * split for r in placed.collect())  # the chain of every archive crosses splits
    found = warc.read_archives(spark, path, split)
    first = {}
    for i, _, h in pages:
        first[h or ""] = max(i, first.get(h or "", i))
    wanted = []
    for i, _, h in pages:
        raw, best = (h or "").encode(), first[h or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        wanted.append((str(i), "response" if i == best else "revisit", None if i == best else str(best), len(raw), digest, True))
    same(found.drop("record_id", "uri"), wanted)
    assert {r["uri"] for r in found.collect()} == {"u"}
    heads = spark.read.option("lineSep", "\r\n").text(path).filter("value rlike '^WARC-Date: [0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}Z$'")
    assert heads.count() == len(pages)


def test_warc_of_other_writers(spark, tmp_path):
    """One gzip member a record, another version, other record types, an altered payload, a dangling revisit."""
    digest = lambda raw: base64.b32encode(hashlib.sha1(raw).digest()).decode()

    def record(version, kind, name, block, *more):
        head = [f"WARC/{version}", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", *more, f"Content-Length: {len(block)}"]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    http, body = "Content-Type: application/http; msgtype=response", b"\xff\x00 WARC/1.1\r\n not UTF-8"
    answer = b"HTTP/1.1 200 OK\r\ncontent-length: %d\r\n\r\n" % len(body)
    stated = f"WARC-Payload-Digest: sha1:{digest(body)}"
    records = [
        record("1.1", "warcinfo", "a", b"software: x\r\n", "Content-Type: application/warc-fields"),
        record("1.1", "response", "b", answer + body, http, stated),
        record("1.0", "response", "c", answer + b"altered", http, stated),
        record("1.0", "revisit", "d", answer, http, stated, "WARC-Refers-To: <urn:uuid:b>"),
        record("1.0", "revisit", "e", answer, http, stated, "WARC-Refers-To: <urn:uuid:none>"),
    ]
    for k, data in enumerate([b"".join(records), b"".join(map(gzip.compress, records))]):
        path = tmp_path / f"of{k}"
        path.mkdir()
        (path / ("x.warc" if k == 0 else "x.warc.gz")).write_bytes(data)
        got = {r["record_id"][-1]: r for r in warc.read_archives(spark, str(path), 200).collect()}
        assert {k: r["type"] for k, r in got.items()} == {"a": "warcinfo", "b": "response", "c": "response", "d": "revisit", "e": "revisit"}
        assert got["b"]["payload_digest"] == digest(body) and got["b"]["payload_bytes"] == len(body)
        assert [got[k]["verified"] for k in "bcde"] == [True, False, True, False]
        assert got["a"]["payload_digest"] == digest(b"software: x\r\n") and got["a"]["id"] is None


def test_warc_odd_rows(spark):
    pages = spark.createDataFrame([(1, "a\nb", "x", 5), (1, None, "x", 5), (None, "u", "x", 5), (None, "u", "y", 5)], "page_id long, url string, html string, digest int")
    found = sorted(((r["id"], r["type"], r["refers_to"]) for r in warc.round_trip(pages).collect()), key=repr)
    assert found == sorted([(1, "response", None), (1, "response", None), (None, "revisit", 1), (None, "response", None)], key=repr)
    assert warc.round_trip(pages.limit(0)).count() == 0
    named = spark.createDataFrame([("a b>\n", "x"), ("é", "x"), ("c", "y")], "page_id string, html string")
    same(warc.round_trip(named, url_col=None).select("id", "type", "refers_to"), [("a b>\n", "revisit", "é"), ("é", "response", None), ("c", "response", None)])


@pytest.mark.parametrize("hot, copies", [(20_000, 1000), (2, 1)])
def test_run_length_index(docs, rows, nothing, hot, copies, monkeypatch):
    monkeypatch.setattr(rindex, "COPIES", copies)
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        if i is not None:
            for k in range(len(raw) - 49):
                first[raw[k : k + 50]] = min(i, first.get(raw[k : k + 50], i))
    wanted = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49 if i is not None else 0):
            if first[raw[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        wanted.append((i, len(raw), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(raw, gone) if not g)).hexdigest()))
    same(rindex.remove_repeats(docs, hot=hot).drop("spans"), wanted)
    assert rindex.remove_repeats(nothing).count() == 0


def test_periodic_texts_are_dealt_out_by_windows(spark):
    """A text of short period is one long stretch: its few distinct windows are handed on, not its bytes."""
    rng = random.Random(8)
    draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    texts = [draw(40) + "-=" * rng.randint(400, 900) + draw(40) + "cell | " * rng.randint(100, 300) for _ in range(40)]
    texts += ["-=" * 30, "=-" * 26 + "x", "x" * 5000, "y" + "x" * 49, "x" * 50, draw(400)]
    first = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], i)
    wanted = []
    for i, t in enumerate(texts):
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        wanted.append((i, len(t), sum(gone), spans, hashlib.sha256("".join(c for c, g in zip(t, gone) if not g).encode()).hexdigest()))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for hot in (20_000, 45):  # 46 documents at most have a minimizer; beyond that only bytes count
        same(rindex.remove_repeats(df, hot=hot).drop("spans"), wanted)
    ends = [draw(40) for _ in range(80)]
    handed = []
    for scale in (1, 8):
        texts = [ends[i] + "-=" * scale * (400 + i) + ends[40 + i] + "cell | " * scale * (100 + i) for i in range(40)]
        table = pa.table({"part": pa.array([0] * 40, pa.int64()), "id": pa.array(range(40), pa.int64()), "text": texts})
        reported = rindex._report(table)
        shared = pa.table({"part": reported.column("part"), "m": reported.column("m"), "hot": pc.greater(reported.column("docs"), 45)})
        handed.append(rindex._hand_on((pa.scalar(0),), table, shared.filter(pc.greater(reported.column("docs"), 1))))
    values = [t.column("value").to_pylist() for t in handed]
    assert set(values[0]) == set(values[1]) and max(map(len, values[1])) <= rindex.WIDEST and any(handed[1].column("hot").to_pylist())


def test_index_streams_patterns_from_outside():
    """Matching statistics and least ids of patterns, some of which no text of the index holds."""
    rng = random.Random(4)
    draw = lambda n: bytes(rng.choice(b"ab\0\xff") for _ in range(n))
    for texts in ([b"banana" * 12, b"ananas" * 10, b"xx"], [draw(rng.randint(1, 300)) for _ in range(12)], [b"abc"], [b"a" * 500, b"a" * 60 + b"b"]):
        texts = list(dict.fromkeys([*texts, texts[0] * 2, texts[-1] + texts[0]]))
        least = np.array([rng.randint(0, 99) for _ in texts])
        index = rindex.RunLengthIndex(texts, least)
        patterns = [*texts, draw(200), b"q" * 70, b"", b"z" + texts[0] + b"z", texts[0][:60] + b"!" + texts[-1], texts[-1][3:] + texts[0], draw(40) + texts[0][:55] + draw(3)]
        wanted = {}
        for k, p in enumerate(patterns):
            for i in range(len(p) - rindex.LENGTH + 1):
                held = [int(x) for t, x in zip(texts, least) if p[i : i + rindex.LENGTH] in t]
                if held:
                    wanted[k, i] = min(held)
        found = {(k, i): x for step in index.match(patterns) for k, i, x in zip(*(v.tolist() for v in step))}
        assert found == wanted


def test_matching_statistics():
    texts, length = [b"abracadabra", b"banana", b"cadabrab"], rindex.LENGTH
    index, rng = rindex.RunLengthIndex(texts, np.arange(3)), random.Random(1)
    for _ in range(50):
        pattern = "".join(rng.choice("abcdnrx") for _ in range(30)).encode()
        row, place, size = (np.full(1, x) for x in (*index.any_row, 0))
        for i in range(len(pattern) - 1, -1, -1):
            row, place, size = index.step(row, place, size, np.array([pattern[i] + 1]))
            longest = max(n for n in range(len(pattern) - i + 1) if any(pattern[i : i + n] in t for t in texts))
            assert size[0] == min(longest, length)
            at = int(place[0])
            assert (index.text[at : at + size[0]] - 1).tolist() == list(pattern[i : i + size[0]])


def chunks_one_by_one(text):
    """Begins of a text's chunks, byte by byte from the definition."""
    boundary = lambda at: at == len(text) or text[at] & 0xC0 != 0x80
    low = lambda at: sum(int(cdc._GEAR[text[at - 1 - back]]) << back for back in range(16)) % 65536 < 65536 // cdc.SPREAD
    found = [at for at in range(cdc.LEAST, len(text) - cdc.LEAST + 1) if boundary(at) and low(at)]
    cuts = [0] + [at for before, at in zip([0, *found], found) if at - before >= cdc.LEAST]
    for begin, stop in zip(list(cuts), [*cuts[1:], len(text)]):
        for at in range(begin + cdc.MOST, stop, cdc.MOST):
            cuts.append(next(x for x in range(at, len(text) + 1) if boundary(x)))
    return sorted({at for at in cuts if at < len(text)})


def test_chunk_dedup_by_brute_force(docs, rows):
    texts = {(i, (t or "").encode()) for i, t in rows}
    pieces = {k: [k[1][a:b] for a, b in zip(cuts, [*cuts[1:], len(k[1])])] for k in texts if k[0] is not None and len(k[1]) >= cdc.RUN for cuts in [chunks_one_by_one(k[1])]}
    least = {}
    for (i, _), parts in pieces.items():
        for part in parts:
            least[part] = min(i, least.get(part, i))
    wanted = []
    for i, t in rows:
        data, kept, run, spans = (t or "").encode(), b"", b"", 0
        for part in [*pieces.get((i, data), [data]), None]:
            if part is not None and (i, data) in pieces and least[part] < i:
                run += part
                continue
            spans, kept, run = (spans + 1, kept, b"") if len(run) >= cdc.RUN else (spans, kept + run, b"")
            kept += part or b""
        wanted.append((i, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    assert sum(r[2] > 0 for r in wanted) >= 3
    same(cdc.removal_report(docs), wanted)


def test_media_features_by_brute_force(docs, rows):
    """Peaks and pairs by loops over frames and bins."""
    got = {r["doc_id"]: r for r in media.fingerprint_media(media.encode_media(docs)).collect()}
    times = {}
    for i, text in rows:
        times[i] = times.get(i, 0) + 1
    checked = 0
    for i, text in rows:
        payload = media.payload_of((text or "").encode())
        if times[i] > 1 or len(payload) > 40_000:
            continue
        samples, peaks = np.frombuffer(payload, np.uint8).astype(np.float32), []
        for frame, at in enumerate(range(0, len(samples) - media.FRAME + 1, media.HOP)):
            part = samples[at : at + media.FRAME]
            power = np.abs(np.fft.rfft((part - part.mean()) * media._HANN)) ** 2
            tops = [k for k in range(1, len(power) - 1) if power[k] > power[k - 1] and power[k] >= power[k + 1] and power[k] > 1.0]
            peaks += [(frame, k) for k in sorted(tops, key=lambda k: -power[k])[: media.PEAKS]]
        pairs = sorted((t, k << 10 | m << 2 | u - t) for t, k in peaks for u, m in peaks if 1 <= u - t <= media.REACH)
        assert list(zip(got[i]["times"], got[i]["codes"])) == pairs
        checked += len(pairs)
    assert checked > 100


def test_toxicity_scores_by_brute_force(spark):
    """Every window of a text through both dictionaries, one by one, and the calibration's formula."""
    import math

    import zstandard

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    found = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}

    def length(word, part):
        held = zstandard.ZstdCompressionDict(part[-toxicity.DICTIONARY_BYTES :] + toxicity._AFTER + toxicity._BEFORE, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=toxicity.LEVEL)
        plain = zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(plain.compress(toxicity._BEFORE + f" {word} ".encode() + toxicity._AFTER))

    gain = {}
    for row in docs.orderBy("doc_id").limit(12).collect():
        words = (row["text"] or "").lower().split()
        for w in words:
            if w not in gain:
                gain[w] = length(w, model.parts[1]) - length(w, model.parts[0])
        gains = sorted((gain[w] for w in words), reverse=True)
        high = [g for g in gains if g >= 2]
        x = [max(0, g) for g in (gains + [0, 0, 0])[:3]] + [math.log(1 + v) for v in (sum(high), len(high), len(gains))]
        z = model.beta[-1] + sum(b * (v - m) / s for b, v, m, s in zip(model.beta, x, model.mean, model.scale))
        assert abs(found[row["doc_id"]] - 1 / (1 + math.exp(-z))) < 1e-9


def test_bpe_works_on_runs_of_a_megabyte():
    """A batch of 8 MB is encoded in runs, whose pieces never stand in memory together."""
    codec = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = "what is said here stands " * 4_000
    batch = pa.RecordBatch.from_arrays([pa.array(range(80)), pa.array([text] * 80)], names=["doc_id", "text_"])
    found = list(bpe._encoded([batch], codec, "doc_id"))
    assert [x for b in found for x in b.column("doc_id").to_pylist()] == list(range(80)) and max(b.num_rows for b in found) <= 10
    assert len({x for b in found for x in b.column("decoded_sha256").to_pylist()} ^ {hashlib.sha256(text.encode()).hexdigest()}) == 0
