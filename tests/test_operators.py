"""Goldens of the operators."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from codexflow.functions.text import tokens
from codexflow.operators import index, layout, linking, publish, search, segments, textdiff, versions
from codexflow.streaming import updates


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def aligned_by_definition(a, b):
    """Remove from the first if no longer alignment is lost by it, else add from the second."""
    if not a or not b:
        return [(i, None) for i in range(len(a))] + [(None, j) for j in range(len(b))]
    size = lambda x, y: sum(i is not None and j is not None for i, j in aligned_by_definition(x, y))
    if a[0] == b[0]:
        first, rest = (0, 0), aligned_by_definition(a[1:], b[1:])
    elif size(a[1:], b) >= size(a, b[1:]):
        first, rest = (0, None), aligned_by_definition(a[1:], b)
    else:
        first, rest = (None, 0), aligned_by_definition(a, b[1:])
    da, db = (int(x is not None) for x in first)
    return [first] + [(None if i is None else i + da, None if j is None else j + db) for i, j in rest]


def test_as_of(spark):
    held = spark.createDataFrame([("L", "r1", "2019-04-01", 0), ("L", "r2", "2020-04-01", 1), ("L", "r3", "2030-01-01", 2), ("M", "m1", None, 0)], "law string, rev string, eff string, pos int")
    found = versions.as_of(held, ["2021-01-01", "2000-01-01"], "law", F.col("eff"), F.col("pos")).select("law", "as_of", "version.rev")
    assert rows(found) == [("L", "2000-01-01", None), ("L", "2021-01-01", "r2"), ("M", "2000-01-01", None), ("M", "2021-01-01", None)]


def test_as_of_keeps_first_of_equals(spark):
    held = spark.createDataFrame([("L", "a", "2020-01-01", 0), ("L", "b", "2020-01-01", 1)], "law string, rev string, eff string, pos int")
    found = versions.as_of(held, ["2021-01-01"], "law", F.col("eff"), F.col("pos"))
    assert found.first()["version"]["rev"] == "a"


def test_merge_is_idempotent(spark):
    low = spark.createDataFrame([("L", "r1", "old", 0), ("L", "r2", "old", 1), (None, None, "x", 2)], "law string, rev string, body string, pos int")
    high = spark.createDataFrame([("L", "r2", "new", 0), ("L", "r3", "new", 1)], low.schema)
    once = versions.merge_histories(low, high, ["law", "rev"], "pos")
    wanted = [(None, None, "x"), ("L", "r1", "old"), ("L", "r2", "new"), ("L", "r3", "new")]
    assert rows(once.select("law", "rev", "body")) == sorted(wanted, key=repr)
    assert rows(versions.merge_histories(once, high, ["law", "rev"], "pos").select("law", "rev", "body")) == sorted(wanted, key=repr)


def test_keyed_diff(spark):
    before = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "k string, v string")
    after = spark.createDataFrame([("b", "3"), ("c", None), ("d", "4")], "k string, v string")
    assert rows(versions.keyed_diff(before, after, ["k"], ["v"]).select("k", "change")) == [("a", "removed"), ("b", "modified"), ("c", "unchanged"), ("d", "added")]


def test_paragraphs_by_number_and_by_position(spark):
    schema = "article string, number string, place int, text string"
    before = spark.createDataFrame([("a", "1", 0, "x"), ("a", "2", 1, "y"), ("b", "", 0, "p"), ("b", "2", 1, "q")], schema)
    after = spark.createDataFrame([("a", "2", 0, "y"), ("a", "3", 1, "z"), ("b", "", 0, "p"), ("b", "3", 1, "q")], schema)
    found = versions.paragraph_diff(before, after, "article", "number", "place", "text").select("article", "key", "change")
    assert rows(found) == [("a", "1", "removed"), ("a", "2", "unchanged"), ("a", "3", "added"), ("b", "#0", "unchanged"), ("b", "#1", "modified")]


def test_numbers_that_repeat(spark):
    schema = "article string, number string, place int, text string"
    before = spark.createDataFrame([("a", "1", 0, "x"), ("a", "1", 1, "y"), ("a", "2", 2, "p"), ("a", "2", 3, "q")], schema)
    after = spark.createDataFrame([("a", "1", 0, "y"), ("a", "1", 1, "x")], schema)
    found = versions.paragraph_diff(before, after, "article", "number", "place", "text").select("key", "old.text", "new.text", "change")
    assert rows(found) == sorted([("1", "y", "y", "unchanged"), ("1", "y", "x", "modified"), ("2", "p", None, "removed"), ("2", "q", None, "removed")], key=repr)
    back = versions.ordered_diff(before, after, ["number"], ["text"], "place", removed_last=False).select("number", "part", "place", "change")
    assert rows(back) == sorted([("1", 0, 0, "unchanged"), ("1", 0, 1, "modified"), ("2", 0, 2, "removed"), ("2", 0, 3, "removed")], key=repr)


@pytest.mark.parametrize("found, baseline, wanted", [(77, 9000, True), (8990, 8971, False), (1, 10, False)])
def test_shrink_guard(spark, found, baseline, wanted):
    assert spark.range(1).select(versions.shrunk(F.lit(found), F.lit(baseline)).alias("v")).first()["v"] is wanted


@pytest.mark.parametrize("seed", range(30))
def test_edit_script_rebuilds_both_sides(seed):
    rng = random.Random(seed)
    a = "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 60)))
    b = "".join(c for c in a if rng.random() > 0.2) + "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 5)))
    ops = textdiff.text_operations(a, b)
    assert "".join(t for o, t in ops if o != "insert") == a
    assert "".join(t for o, t in ops if o != "delete") == b
    assert all(x[0] != y[0] for x, y in zip(ops, ops[1:]))
    script = textdiff.edit_script(list(a), list(b))
    shared = sum(len(t) for o, t in script if o == "equal")
    assert shared >= sum(m.size for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks())


def test_alignment_prefers_removal():
    assert textdiff.common_subsequence(["a", "b"], ["b", "a"]) == [(0, None), (1, 0), (None, 1)]
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        assert textdiff.common_subsequence(a, b) == aligned_by_definition(a, b)
    assert textdiff.assign_spans([(0, 2, "x"), (1, 6, "y"), (6, 8, "z")]) == [(1, 6, "y"), (6, 8, "z")]


@pytest.mark.parametrize("most", [500_000, 2])
def test_automaton_modes(spark, monkeypatch, most):
    monkeypatch.setattr(linking, "MOST_PATTERNS", most)
    texts = spark.createDataFrame([(1, "甲法施行法"), (2, None), (3, "甲\n法\n甲法"), (4, "")], "id int, text string")
    patterns = ["甲法", "甲法施行法", "施行", "法", ""]
    find = lambda mode: [tuple(r) for r in linking.find_patterns(texts, "id", "text", patterns, mode).filter("id = 1").select("begin", "stop").collect()]
    assert set(find("overlapping")) == {(0, 2), (1, 2), (2, 4), (0, 5), (4, 5)}
    assert find("longest") == [(0, 5)]
    assert find("earliest") == [(0, 2), (2, 4), (4, 5)]
    held = linking.patterns_held(texts, "id", "text", patterns)
    assert rows(held) == sorted([(1, ["施行", "法", "甲法", "甲法施行法"], [1, 1, 1, 1]), (3, ["法", "甲法"], [2, 1])], key=repr)
    rest = linking.find_patterns(texts, "id", "text", ["甲法"], tail=2).select("id", "rest")
    assert rows(rest) == [(1, "施行"), (3, "")]


def test_stored_index(spark, tmp_path):
    docs = spark.createDataFrame([(1, "b a b"), (2, None), (3, "条約改正 A")], "key int, text string")
    path = str(tmp_path / "index")
    index.write_index({"law": docs, "none": docs.limit(0)}, path)
    held = spark.read.parquet(f"{path}/postings").select("kind", "token", "id", "tf", "dl")
    assert rows(held) == sorted([("law", "a", "1", 1, 3), ("law", "b", "1", 2, 3), ("law", "条約", "3", 1, 4), ("law", "約改", "3", 1, 4), ("law", "改正", "3", 1, 4), ("law", "a", "3", 1, 4)], key=repr)
    assert [r["id"] for r in index.search(spark, path, "law", [["条約", "a"]]).collect()] == ["3"]
    assert index.search(spark, path, "none", [["a"]]).count() == index.search(spark, path, "law", []).count() == 0
    plan = index.postings(spark, path, "law", ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(token,a)" in plan


def test_index_shuffles_no_posting(spark, tmp_path):
    """Postings are counted where a document is read; rows that repeat an id are still one document."""
    docs = spark.createDataFrame([("b", "2", 3, ["x", "y", "x"]), ("a", "1", 1, ["y"]), ("a", "0", 2, ["z", "y"]), ("a", None, 0, [])], "kind string, id string, dl long, tokens array<string>").coalesce(1)
    found = index.counted(docs)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("a", "y", "0", 1, 2), ("a", "y", "1", 1, 1), ("a", "z", "0", 1, 2), ("b", "x", "2", 2, 3), ("b", "y", "2", 1, 3)]
    path = str(tmp_path / "index")
    index.write_index({"law": spark.createDataFrame([(1, "a"), (1, "a"), (2, "a b"), (None, "c"), (None, "c")], "key int, text string")}, path)
    held = spark.read.parquet(f"{path}/postings").select("token", "id", "tf")
    assert rows(held) == sorted([("a", "1", 2), ("a", "2", 1), ("b", "2", 1), ("c", None, 2)], key=repr)


def test_tokens_of_plain_texts_equal_those_of_any(spark):
    texts = ["Ab c1-d", "ÄB ΣΑΣ İx e\u0301", "第1条 Ab", "", None, "a_b\u00b2"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(tokens(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in found] == [["ab", "c1", "d"], ["äb", "σας", "i\u0307x", "e"], ["第", "1", "条", "ab"], [], [], ["a", "b\u00b2"]]


def test_cross_references(spark):
    texts = spark.createDataFrame([("A", "民法第十条の二及び刑法を準用する。民法"), ("B", "民法第一条")], "id string, text string")
    titles = spark.createDataFrame([("民法", "B"), ("刑法", "C")], "title string, target string")
    articles = spark.createDataFrame([("B", "第十条"), ("B", "第十条の二"), ("B", "第一条")], "target string, article_no string")
    found = linking.cross_references(texts, "id", "text", titles, articles).select("id", "title", "begin", "article_no")
    assert rows(found) == sorted([("A", "民法", 0, "第十条の二"), ("A", "刑法", 9, None), ("A", "民法", 17, None)], key=repr)


def test_neighbour_references(spark):
    held = spark.createDataFrame([("L", 1, "a1", "本文"), ("L", 2, "a2", "前条の規定"), ("L", 3, "a3", "次条")], "law string, pos int, art string, text string")
    assert rows(linking.neighbour_references(held, "law", "pos", "art", "text", "前条", "次条")) == [("L", "a2", "previous", "a1")]


def test_search_with_synonyms(spark):
    docs = spark.createDataFrame([(1, "事業者の責務"), (2, "自動車の登録"), (3, "車両の登録")], "id int, text string")
    groups = search.query_groups("自動車", {"自動車": ["車両"], "_x": ["y"]})
    assert groups == [["自動", "動車"], ["車両"]]
    found = search.match(search.postings(docs, "id", ["text"]), groups)
    assert rows(found) == [(2,), (3,)]
    scored = search.bm25(docs, "id", ["text"], groups)
    assert {r["id"] for r in scored.collect()} == {2, 3}
    assert search.query_groups("a") == []


def test_bigrams_join_again(spark):
    parts = spark.createDataFrame([(["東京", "京駅", "Hello", "World", "...", "検索"],)], "p array<string>")
    assert parts.select(search.join_bigrams(F.col("p")).alias("v")).first()["v"] == "東京駅Hello World...検索"


def test_feed_order(spark):
    schema = "kind string, date string, title string, link string"
    a = spark.createDataFrame([("law", "2026-06-01", "x", "1"), ("law", "2026-05-01", "y", "2")], schema)
    b = spark.createDataFrame([("bill", "2026-06-01", "z", "3")], schema)
    assert [r["link"] for r in publish.feed([a, b]).collect()] == ["3", "1", "2"]
    assert "<title>[法令] x</title>" in publish.rss(publish.feed([a, b]), "t", "/").first()["value"]


def test_feed_entries(spark):
    rows = spark.createDataFrame([("law", "2026-06-01", 'a<b & "c"', "/laws/1", "it's"), ("new", "soon", None, "https://x.example/?a=1&b=2", None), ("law", "2026-02-31", "t", None, "")], "kind string, date string, title string, link string, summary string")
    found = [r[0] for r in rows.select(publish.rss_entry(rows, "https://a.example/")).collect()]
    assert found[0] == '<item><title>[法令] a&lt;b &amp; &quot;c&quot;</title><link>https://a.example/#/laws/1</link><guid isPermaLink="false">law:2026-06-01:/laws/1</guid><pubDate>Mon, 01 Jun 2026 00:00:00 +0000</pubDate><description>it\'s</description></item>'
    assert found[1] == '<item><title>[new] </title><link>https://x.example/?a=1&amp;b=2</link><guid isPermaLink="false">new:soon:https://x.example/?a=1&amp;b=2</guid></item>'
    assert "pubDate" not in found[2] and "<description></description>" in found[2]
    value = publish.rss(rows, "t", "/", "d").first()["value"]
    assert value.count("<item>") == 3 and "<lastBuildDate>Mon, 01 Jun 2026" in value
    empty = publish.rss(rows.limit(0), "t & u", "/", "d").first()["value"]
    assert empty.endswith("<channel><title>t &amp; u</title><description>d</description><link>/</link></channel></rss>")


def test_segments(spark):
    docs = spark.createDataFrame([(1, "甲\n第一条\na\n第二条\nb"), (2, None)], "id int, text string")
    found = segments.line_segments(docs, "id", "text", lambda x: x.rlike("^第.条$"))
    assert rows(found) == [(1, 0, 1, "甲"), (1, 1, 2, "第一条\na"), (1, 2, 2, "第二条\nb"), (2, 0, 1, "")]
    best = segments.best_segment(found, "id", "text", "segment", ["b"])
    assert rows(best)[0][:2] == (1, 2)


def test_line_functions(spark):
    row = spark.createDataFrame([("第一条　甲は\n乙とする。\n丙\n２　丁", "a\n\n\n\nb")], "x string, y string")
    got = row.select(segments.joined_lines(F.col("x"), "^[２第]").alias("x"), segments.squeezed_lines(F.col("y")).alias("y")).first()
    assert got["x"] == "第一条　甲は乙とする。\n丙\n２　丁"
    assert got["y"] == "a\n\nb"


def test_clusters_by_head(spark):
    row = spark.createDataFrame([([1.0, 8.0, 12.0, 30.0],)], "v array<double>")
    assert row.select(segments.head_clusters(F.col("v"), 10.0).alias("h")).first()["h"] == [1.0, 12.0, 30.0]


def test_vertical_reading_order(spark):
    words = [(1, 300.0, 100.0, 200.0, "第一章"), (1, 280.0, 100.0, 205.0, "条"), (1, 300.0, 300.0, 400.0, "下段"), (1, 280.0, 300.0, 330.0, "末"), (1, 302.0, 210.0, 220.0, "続")]
    df = spark.createDataFrame(words, "page int, x double, y double, y1 double, text string")
    assert layout.reading_order(df).first()["text"] == "第一章\n条\n続下段\n末"


def test_bands_of_a_comparison(spark):
    words = [(1, 300.0, 100.0, 140.0, "改正後"), (1, 300.0, 500.0, 540.0, "改正前"), (1, 280.0, 100.0, 200.0, "新しい文"), (1, 280.0, 500.0, 600.0, "古い文")]
    df = spark.createDataFrame(words, "page int, x double, y double, y1 double, text string")
    assert tuple(layout.compared_bands(df).first())[1:] == ("改正後\n新しい文", "改正前\n古い文")


def test_ruled_table(spark):
    rules = spark.createDataFrame([(1, k, p) for k, p in [("v", 0.0), ("v", 50.0), ("v", 100.0), ("h", 0.0), ("h", 40.0), ("h", 80.0)]], "page int, kind string, pos double")
    words = spark.createDataFrame([(1, 70.0, 10.0, 20.0, "甲"), (1, 70.0, 50.0, 60.0, "乙"), (1, 20.0, 10.0, 20.0, "丙")], "page int, x double, y double, y1 double, text string")
    assert layout.ruled_tables(rules, words).first()["cells"] == [["甲", "乙"], ["丙", ""]]


def test_lookback(spark):
    found = spark.range(1).select(updates.dates_to_fetch(F.lit("2026-06-10").cast("date"), F.lit("2026-06-11").cast("date")).alias("d")).first()["d"]
    assert [str(d) for d in found] == ["2026-06-07", "2026-06-08", "2026-06-09", "2026-06-10", "2026-06-11"]


def test_stream_deduplication(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string").selectExpr("k", "v", "timestamp'2026-01-01' as ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, v string, ts timestamp").parquet(str(tmp_path / "in"))
    done = updates.deduplicated(stream, ["k"], "ts").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    done.awaitTermination(60)
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("k", "v")) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("letters, sizes", [(3, (700, 900)), (400, (1500, 700)), (90, (1200, 1300))])
def test_edit_script_beyond_the_trace_is_shortest(letters, sizes):
    rng = random.Random(letters)
    a, b = ([f"{rng.randrange(letters)} " for _ in range(n)] for n in sizes)
    b[100:400] = a[200:500]
    best = [0] * (len(b) + 1)
    for unit in a:
        row = [0]
        for j, other in enumerate(b):
            row.append(best[j] + 1 if unit == other else max(best[j + 1], row[j]))
        best = row
    assert len(a) + len(b) - 2 * best[-1] > textdiff.MOST_EDITS
    script = textdiff.edit_script(a, b)
    assert "".join(t for op, t in script if op != "insert") == "".join(a)
    assert "".join(t for op, t in script if op != "delete") == "".join(b)
    assert sum(len(t.split()) for op, t in script if op == "equal") == best[-1]
    assert textdiff._common_lengths(list(map(int, a)), list(map(int, b)))[-1] == best[-1]


def test_before_and_after_shuffles_no_line(spark):
    texts = ["前\n改正前\n改正後\n甲\n 改正前　\n乙\n改正前\n改正後\n\n", "改正後\nx", "改正前", None]
    found = segments.before_and_after(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "k", "t")
    assert rows(found) == [(0, 0, "前\n改正前", "", ""), (0, 1, "", "甲", "乙\n改正前")]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(20))
def test_edit_script_is_the_same_by_each_method(monkeypatch, seed):
    rng = random.Random(seed)
    a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randint(1, 60))) for _ in range(2))
    a, b = sorted((a, b + a[5:40]), key=len)
    kept = textdiff._by_vectors(a, b)
    assert kept == textdiff._by_frontiers(a, b, 200) and all(a[i] == b[j] for i, j in zip(*kept))
    for name, value in (("MOST_BITS", 50), ("PARTS", 3), ("MOST_MASKS", 2)):
        monkeypatch.setattr(textdiff, name, value)
    assert kept == textdiff._by_vectors(a, b)
    assert [x for op, x in textdiff.edit_script(a, b) if op != "insert"] and textdiff.edit_script(a, b) == textdiff.edit_script(list(a), list(b))
    assert sum(len(t) for op, t in textdiff.edit_script(a, b) if op == "equal") == len(kept[0])


def test_text_diffs_are_not_brought_into_one_task(spark):
    from codexflow.plans.registry import QUERIES

    found = QUERIES["text_diff_chars"](spark, "/root/testdata/sf0.001")
    tasks = found.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) > 4 and sum(r["count"] for r in tasks) == found.count()


def test_long_texts_are_compared_by_characters_too():
    before = "lighthouse keeper " * 4_000
    after = before[:36_000] + "lighthouze" + before[36_010:]
    assert len(before) > 50_000
    assert textdiff.text_operations(before, after) == [("equal", before[:36_008]), ("delete", "s"), ("insert", "z"), ("equal", before[36_009:])]
