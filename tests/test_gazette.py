"""Gazette days, index rows and feeds of the corpora."""

from pyspark.sql import functions as F

from codexflow.operators import corpora, gazette, publish


def test_amendment_texts(spark):
    items = spark.createDataFrame([(1, 1, "水産庁令の一部を改正する省令（水産四二）", 2), (1, 2, "漁港告示の一部を改正する件", 3), (1, 3, "公示", 5)], "issue int, item int, title string, page int")
    pages = spark.createDataFrame([(1, 2, "官\n〇水産庁令第四十二号\n水産庁令の一部を次のように改正する。\n甲を乙に改める。"), (1, 3, "〇告示第三号\n漁港告示の一部を\n丙を加える。"), (1, 4, "改正後\n改正前"), (1, 5, "公示\n末")], "issue int, page int, text string")
    found = {r["item"]: r for r in gazette.amendment_texts(items, pages).collect()}
    assert set(found) == {1, 2}
    assert found[1]["amend_text"].startswith("〇水産庁令第四十二号") and found[1]["amend_format"] == "prose"
    assert found[2]["amend_text"].startswith("〇告示第三号") and found[2]["amend_format"] == "shinkyu"


def test_titles_that_segments_name(spark):
    rows = [("甲乙丙", "甲乙丙", False), ("甲乙丙丁", "x甲乙丙丁", True), ("甲乙丙丁戊己庚", "甲乙丙丁戊己", False), ("甲乙丙丁戊己庚辛", "甲乙丙丁戊己", True), ("甲乙丙丁戊己庚辛壬", "甲乙丙丁戊己", False), ("一二三四五六七八九十甲乙", "一二三四五六", True), ("甲乙丙丁", "別の記事", False)]
    df = spark.createDataFrame([r[:2] for r in rows], "core string, text string")
    assert [r[0] for r in df.select(gazette.names_title(F.col("text"), F.col("core"))).collect()] == [r[2] for r in rows]
    items = spark.createDataFrame([(1, 1, "漁港整備規則の一部を改正する省令", 1)], "issue int, item int, title string, page int")
    pages = spark.createDataFrame([(1, 1, "〇告示\n別の件について次のように定める。")], "issue int, page int, text string")
    assert gazette.amendment_texts(items, pages).count() == 0


def test_events_link_to_items(spark):
    events = spark.createDataFrame([("e1", "2026-04-01", "灯台見学法等の一部を改正する法律"), ("e2", "2026-04-02", "灯台見学法等の一部を改正する法律"), ("e3", "2026-04-01", "別の法律")], "event string, date string, title string")
    items = spark.createDataFrame([("2026-04-01", 1, 5, "灯台見学法等の一部を改正する法律（水産一）"), ("2026-04-01", 1, 2, "新灯台見学法等特例")], "date string, issue int, item int, title string")
    found = {r["event"]: r["kanpo"] for r in gazette.linked_events(events, gazette.item_matches(events, items)).collect()}
    assert found["e1"]["linked"] and found["e1"]["confidence"] == 0.95 and found["e1"]["item"] == 5
    assert found["e2"] is None and found["e3"] is None


def test_feed_of_all_corpora(spark):
    updates = spark.createDataFrame([("2026-05-01", "L1", "灯台見学法", "amended"), ("x", "L2", "t", "added")], "date string, law_id string, title string, change_type string")
    cases = spark.createDataFrame([("c1", "案", "open", "2026-06-01", "2026-07-01", None, "甲法"), ("c2", "果", "closed", None, None, "", None), ("c3", "果", "closed", None, None, "2026-03-01", None), ("", "果", "closed", None, None, "2026-03-01", None)], "case_id string, title string, status string, reception_start string, reception_end string, result_published string, related_law_name string")
    items = spark.createDataFrame([("2026-04-02", "省令", "u", "改める"), ("2026-04-03", "告示", "u", "")], "date string, title string, pdf_url string, amend_text string")
    bills = spark.createDataFrame([("b1", "案", "衆法", "", "付託", "")], "bill_id string, title string, bill_type string, status string, latest_event string, latest_date string")
    feed = publish.feed([corpora.law_feed(updates), corpora.comment_feed(cases), corpora.gazette_feed(items), corpora.bill_feed(bills)]).collect()
    assert [(r["kind"], r["date"], r["summary"]) for r in feed] == [("pubcomment", "2026-07-01", "意見募集中（締切） · 関連: 甲法"), ("law", "2026-05-01", "改正"), ("gazette", "2026-04-02", "改める"), ("pubcomment", "2026-03-01", None)]


def test_index_rows(spark):
    laws = spark.createDataFrame([("L", "灯台見学法", "令和四年", [("art_1", "第一条", None, [("1", "灯台は"), ("2", None)])])], "law_id string, title string, law_num string, articles array<struct<article_id:string,article_no:string,caption:string,paragraphs:array<struct<paragraph_no:string,text:string>>>>")
    assert tuple(corpora.law_rows(laws).first()) == ("L", "art_1", "灯台見学法 令和四年", "第一条 灯台は\n")
    speeches = spark.createDataFrame([("m1", "s1", "話"), ("m1", "s2", " "), ("m9", "s3", "話")], "meeting_id string, speech_id string, speech string")
    meetings = spark.createDataFrame([("m1", "水産", "2026-01-01"), ("m1", "水産", "2026-01-01")], "meeting_id string, committee string, date string")
    assert [r["speech_id"] for r in corpora.speech_rows(speeches, meetings).collect()] == ["s1"]
    days = spark.createDataFrame([("2026-04-01", [("i.pdf", [("t", 3, "", [("L9", "x")], None), ("", 4, "", [], None)])])], "date string, issues array<struct<pdf_url:string,items:array<struct<title:string,page:int,pdf_url:string,linked_laws:array<struct<law_id:string,title:string>>,amend_text:string>>>>")
    assert [(r["title"], r["pdf_url"], r["law_id"]) for r in corpora.gazette_rows(days).collect()] == [("t", "i.pdf", "L9")]
    sets = spark.createDataFrame([("shotoku", "L", [("1-1", "c", "文"), ("1-2", "c", "")])], "tax string, parent_law_id string, items array<struct<number:string,caption:string,text:string>>")
    assert [r["number"] for r in corpora.circular_rows(sets).collect()] == ["1-1"]


def test_item_matches_equal_all_pairs(spark):
    import random

    pick = random.Random(5)
    name = lambda: "".join(pick.choice("甲乙丙") for _ in range(pick.choice([1, 3, 4, 5, 7, 12])))
    events = [(i, pick.choice(["a", "b", None]), pick.choice([name(), None]) if i % 9 == 0 else name()) for i in range(150)]
    items = [(pick.choice("ab"), pick.randrange(4), i, name()) for i in range(400)]
    want = {}
    for event, date, title in events:
        scored = []
        for day, issue, item, other in items:
            if title is None or date != day:
                continue
            score = 1.0 if title == other else 0.8 if min(len(title), len(other)) >= 4 and (title in other or other in title) else 0
            scored += [(-round(0.5 + 0.45 * score, 4), issue, item, other)] if score else []
        if scored:
            want[event] = min(scored)
    left = spark.createDataFrame(events, "event int, date string, title string")
    right = spark.createDataFrame(items, "date string, issue int, item int, title string")
    found = {r["event"]: (-r["confidence"], r["issue"], r["item"], r["item_title"]) for r in gazette.item_matches(left, right).collect()}
    assert found == want and len(want) > 40
    assert gazette.item_matches(left, right.limit(0)).count() == 0 and gazette.item_matches(left.limit(0), right).count() == 0


def test_a_date_of_equal_titles_makes_no_pairs(spark):
    rows = spark.range(20_000).select(F.col("id").alias("event"), F.lit("a").alias("date"), F.lit("甲乙丙丁規則").alias("title"))
    found = gazette.item_matches(rows, rows.select("date", F.lit(1).alias("issue"), F.col("event").alias("item"), "title"))
    assert found.groupBy("item", "confidence").count().collect() == [(0, 0.95, 20_000)]


def test_item_title_match_where_items_hold_titles_of_events(spark, tmp_path):
    """``old plate`` stands in ``cold plate``: an event's title held by an item's is no match of the query."""
    import parity

    from codexflow.plans.registry import ORACLE_SQL, QUERIES

    names = ["old plate", "cold plate", "old plate", "bold cold plate", "hot gear", "hot gear"]
    rows = [(k, name, "LARGE", size) for size in (1, 2) for k, name in enumerate(names[size - 1 :], 10 * size)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    con = parity.connect("/root/testdata/sf0.001")
    con.execute(f"create or replace view part as select * from read_parquet('{tmp_path}/part.parquet/*.parquet')")
    assert parity.difference(QUERIES["item_title_match"](spark, str(tmp_path)), con, ORACLE_SQL["item_title_match"]) == ""
