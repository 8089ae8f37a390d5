"""Sources and sinks over small fixtures."""

import hashlib
import io
import random
import re
import shutil
import zipfile

import zstandard
from pyspark.sql import functions as F

from codexflow.sources import files, lawxml, markup, sinks

LAW = """<?xml version="1.0"?><DataRoot><Result><Code>0</Code></Result><Law Era="Reiwa" Year="4" PromulgateMonth="11" PromulgateDay="8"><LawNum>令和四年法律第九百一号</LawNum>
<LawBody><LawTitle>灯台見学法</LawTitle><TOC><Article Num="3"><Paragraph Num="1"/></Article></TOC><MainProvision><Chapter><Article Num="1"><ArticleCaption>（見学の日）</ArticleCaption><ArticleTitle>第一条</ArticleTitle>
<Paragraph Num="1"><ParagraphNum/><ParagraphSentence><Sentence>灯台は、</Sentence><Sentence>日曜に開く。</Sentence></ParagraphSentence><Item Num="1"><ItemTitle>一</ItemTitle><ItemSentence><Sentence>雨の日を除く</Sentence></ItemSentence></Item></Paragraph></Article></Chapter></MainProvision>
<SupplProvision AmendLawNum="令和六年法律第九百二号"><SupplProvisionLabel>附則</SupplProvisionLabel><Paragraph Num="1"><ParagraphSentence><Sentence>翌月から行う。</Sentence></ParagraphSentence></Paragraph></SupplProvision>
<AppdxTable><Article Num="5"/></AppdxTable></LawBody></Law></DataRoot>"""


def test_law_document(spark):
    dated = LAW.replace("<LawBody>", "<PromulgationDate>2022年12月1日</PromulgationDate><LawBody>")
    raw = spark.createDataFrame([("L1", LAW.encode()), ("L2", b"<html>"), ("L3", None), ("L4", dated.encode())], "law_id string, xml binary")
    found = {r["law_id"]: r for r in lawxml.law_documents(raw).collect()}
    law = found["L1"]
    assert (law["title"], law["era"], law["year"], law["month"], law["day"], law["promulgated"]) == ("灯台見学法", "Reiwa", 4, 11, 8, "2022-11-08")
    assert found["L4"]["promulgated"] == "2022-12-01" and found["L3"]["promulgated"] is None
    assert [a["article_id"] for a in law["articles"]] == ["art_1"]
    assert law["articles"][0]["paragraphs"][0]["text"] == "灯台は、日曜に開く。\n一 雨の日を除く"
    assert law["suppl_provisions"][0]["articles"][0]["article_id"] == "suppl1_art_preamble"
    assert found["L2"]["articles"] is None and found["L2"]["title"] == "L2"


def test_law_without_articles(spark):
    xml = "<Law><LawBody><MainProvision><Paragraph Num='1'><ParagraphSentence><Sentence>文</Sentence></ParagraphSentence></Paragraph></MainProvision></LawBody></Law>"
    found = lawxml.law_documents(spark.createDataFrame([("L", xml.encode())], "law_id string, xml binary")).first()
    assert found["articles"][0]["article_id"] == "art_preamble" and found["articles"][0]["article_no"] == "本則"


def test_update_list(spark):
    df = spark.createDataFrame([("<R><Result><Code>0</Code></Result><LawId>b</LawId><LawID>a</LawID><LawId>b</LawId></R>",), ("<R><Result><Code>1</Code></Result><LawId>b</LawId></R>",)], "x string")
    assert [r["v"] for r in df.select(lawxml.law_ids(F.col("x")).alias("v")).collect()] == [["a", "b"], []]


def test_zip_and_encodings(spark):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("../evil.xml", "no")
        z.writestr("a/law.xml", "<Law/>")
    df = spark.createDataFrame([(held.getvalue(),), (b"<x/>",), (None,)], "c binary")
    assert [r["v"] for r in df.select(files.unzipped_xml("c").alias("v")).collect()] == [b"<Law/>", b"<x/>", None]
    df = spark.createDataFrame([("議案①".encode("cp932"),)], "c binary")
    assert df.select(files.legacy_text("c").alias("v")).first()["v"] == "議案①"


def test_history_bundles(spark, tmp_path):
    lines = '{"revision_id":"r1","status":"x"}\n\n{"revision_id":".hidden","status":"y"}\n'
    (tmp_path / "history.ndjson.zst").write_bytes(zstandard.compress(lines.encode()))
    found = files.history_lines(spark, str(tmp_path), "revision_id string, status string")
    assert [tuple(r) for r in found.collect()] == [("r1", "x")]


def test_json_records(spark):
    meeting = '{"meetingRecord":[{"issueID":"m1","session":"213","nameOfHouse":"衆議院","date":"2024-01-26","speechRecord":[{"speechID":"s1","speechOrder":1,"speaker":"甲","speech":"x"},{"speechID":"","speech":"y"}]}]}'
    found = files.meeting_rows(spark.createDataFrame([(meeting,), ("{",)], "j string"), "j").collect()
    assert [(r["meeting_id"], r["session"], r["speech_id"], r["place"]) for r in found] == [("m1", 213, "s1", 1)]
    stats = '{"GET_STATS_DATA":{"STATISTICAL_DATA":{"DATA_INF":{"VALUE":[{"@area":"01","@time":"2020","$":"5"},{"@area":"02","$":""}]}}}}'
    found = files.statistic_rows(spark.createDataFrame([(stats,)], "j string"), "j").collect()
    assert [(r["area"], r["value"]) for r in found] == [("01", "5")]
    meta = '{"law_info":{"law_id":"L"},"revisions":[{"law_revision_id":"r1"},{"law_revision_id":"r2"}]}'
    assert [r["law_revision_id"] for r in files.revision_rows(spark.createDataFrame([(meta,)], "j string"), "j").orderBy("place").collect()] == ["r1", "r2"]


def test_notices(spark, tmp_path):
    (tmp_path / "n.xml").write_text("<r><item><id>1</id><title>a</title></item><notice><noticeId>2</noticeId><name>b</name><type>公告</type></notice><item><id>3</id></item></r>")
    found = sorted((r["item_id"], r["title"], r["notice_type"]) for r in files.notice_rows(spark, str(tmp_path)).collect())
    assert found == [("1", "a", "不明"), ("2", "b", "公告")]


def test_html(spark):
    page = "<html><head><title> A  B </title><script>x<p></script></head><body><h2>甲</h2><p>1<br>2</p><h2>乙</h2><p>3</p><table><tr><th>件 名</th><td>x</td></tr><tr><th>件名</th><td>y</td></tr></table><a href='/c?id=12#f' onclick='go(id=12)'>c</a><a href='/c?id=12'>d</a></body></html>"
    df = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    nodes = markup.html_nodes(df, "id", "html")
    assert [(r["caption"], r["text"]) for r in markup.captioned(nodes).orderBy("place").collect()] == [("甲", "12"), ("乙", "3")]
    assert [(r["label"], r["value"]) for r in markup.label_values(nodes).collect()] == [("件名", "x")]
    assert [(r["url"], r["text"]) for r in markup.links(nodes).collect()] == [("/c?id=12", "c")]
    assert nodes.filter("tag = 'a'").select(markup.case_id(F.col("onclick")).alias("v")).first()["v"] == "12"
    assert df.select(markup.title_of(F.col("html")).alias("t")).first()["t"] == "A B"


def test_manifest(spark, tmp_path):
    root = tmp_path / "public"
    (root / "laws").mkdir(parents=True)
    (root / "laws" / "index.json").write_text("{}")
    (root / "manifest.json").write_text("{}")
    found = sinks.manifest(spark, str(root))
    assert [(r["path"], r["bytes"], r["content_type"]) for r in found.collect()] == [("laws/index.json", 2, "application/json")]
    stated = found.withColumn("bytes", F.lit(3).cast("long"))
    assert [tuple(r) for r in sinks.mismatches(stated, found).collect()] == [("laws/index.json", "changed")]
    assert sinks.mismatches(found, found).count() == 0
    assert tuple(sinks.compression_stats(spark, str(root)).first()) == (2, 4)


def test_folder_manifest_and_health(spark, tmp_path):
    root = tmp_path / "public"
    for name, text in (("a/x.json", "1"), ("a/y.json", "22"), ("b/x.json", "1"), ("health.json", "z"), ("_SUCCESS", "")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    found = sinks.folder_manifest(spark, str(root))
    rows = {r["path"]: r for r in found.collect()}
    digest = lambda *texts: hashlib.sha256("".join(sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)).encode()).hexdigest()
    assert sorted(rows) == ["a", "b"] and (rows["a"]["bytes"], rows["a"]["files"], rows["a"]["sha256"]) == (3, 2, digest("1", "22"))
    assert [r["path"] for r in sinks.folder_manifest(spark, str(root), "^b").collect()] == ["b"]
    other = tmp_path / "again" / "public"
    shutil.copytree(root, other)
    (other / "a" / "y.json").rename(other / "a" / "renamed.json")
    again = sinks.folder_manifest(spark, str(other))
    assert sinks.mismatches(found, again).count() == 0
    days = spark.createDataFrame([("2031-01-02",), (None,), ("2030-01-01",)], "day string")
    assert tuple(sinks.health(found, sinks.mismatches(found, again), days, "day").first()) == (True, "2031-01-02", 3, 2, 4, 0)
    none = found.limit(0)
    assert tuple(sinks.health(none, sinks.mismatches(found, none), days.limit(0), "day").first()) == (False, None, 0, 0, 0, 2)


def test_plain_pages_are_read_like_others(monkeypatch):
    plain = ["<td>", "</td>", "<td>a</td>", "<th>b  c</th>", "<td headers='X'>　z\n</td>", "<tr>", "</tr>", "<td headers=\"NAIYO\" class='a b'>", " x\n y", "<br>", "<img href='q'>", "</p>", "<p>", "<a href='/x?y=1' class='file' href=''>", "</a>", "<h1 id='i' headers='' tag='n'>"]
    other = ["&amp;", "<!-- c -->", "<script>", "</script>", "<TD>", "<td headers=K>", "<td/>", "< x", "<title>", "</title>", "<td headers='a>b'>", "</td >", "<noscript>", "<?pi?>", "<td  headers='K'>"]
    rng = random.Random(8)
    pages = ["".join(rng.choice(plain + other * (n % 2)) for _ in range(rng.randint(0, 12))) for n in range(3000)]
    found = [(markup.parse_nodes(p), markup.parse_nodes(p, ("td", "a")), markup.parse_cells(p)) for p in pages]
    assert sum(bool(markup.PLAIN.fullmatch(p)) for p in pages) > 1500
    monkeypatch.setattr(markup, "PLAIN", re.compile("(?!)"))
    for page, (nodes, some, cells) in zip(pages, found):
        wanted = markup.parse_nodes(page)
        assert nodes == wanted and some == [n for n in wanted if n["tag"] in ("td", "a")]
        assert [(c["tag"], c["headers"], c["text"]) for c in cells] == [(n["tag"], n["headers"], n["text"]) for n in wanted if n["tag"] in ("th", "td")]


def test_pages_of_orders_are_not_read_in_one_task(spark):
    from codexflow.plans.registry import QUERIES

    found = QUERIES["bill_progress_pages"](spark, "/root/testdata/sf0.001")
    assert found.select(F.spark_partition_id().alias("task")).distinct().count() > 4
