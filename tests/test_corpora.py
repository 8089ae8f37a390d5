"""Goldens of gazette functions and of the pages of the corpora."""

import pytest
from pyspark.sql import functions as F

from codexflow.functions import gazette
from codexflow.sources import corpora, markup


@pytest.mark.parametrize(
    "function, given, wanted",
    [
        (gazette.upright, "︵令和︶︒", "（令和）。"),
        (gazette.is_margin, "令和 ８年６月12日", True),
        (gazette.is_margin, "第一条", False),
        (gazette.without_lead, "官  第一条", "第一条"),
        (gazette.without_lead, "官報", "官報"),
        (gazette.cleaned, "官\n本文\n\n\n\n令和８年６月１２日\n次", "本文\n\n次"),
        (gazette.is_boundary, "〇水産庁令第四十二号", True),
        (gazette.is_boundary, "　告示　", True),
        (gazette.is_boundary, "法律をここに公布する。", True),
        (gazette.is_boundary, "告示する", False),
        (gazette.amending_score, "甲に改める", 1005),
        (gazette.is_row_heading, "（定義等）", True),
        (gazette.is_row_heading, "（傍線部分は改正部分）", False),
        (gazette.is_row_heading, "別表第一", True),
        (gazette.issue_kind, "号外　第12号", "extra"),
        (gazette.issue_kind, "本文 第1号", None),
        (gazette.issue_number, "本紙 第1234号", "第1234号"),
        (gazette.item_title, "省令（水産四二） 3", "省令（水産四二）"),
        (gazette.agency, "省令（水産四二）", "水産四二"),
        (gazette.enactment_number, "告示第3号 条例第１２号", "条例第１２号"),
        (gazette.enactment_number, "なし", None),
        (gazette.is_number_like, "２−5　", True),
        (gazette.is_number_like, "−", False),
    ],
)
def test_gazette_functions(spark, function, given, wanted):
    assert spark.createDataFrame([(given,)], "x string").select(function(F.col("x")).alias("v")).first()["v"] == wanted


def nodes(spark, key, html):
    return markup.html_nodes(spark.createDataFrame([(key, html)], "id string, html string"), "id", "html")


def test_gazette_contents(spark):
    day = "20310203"
    link = lambda page, t: f"<a href='{day}h00345/{day}h00345{page}f.html'>{t} {int(page)}</a>"
    html = f"<a href='x'>{link('0001', 'before')}</a><a>本紙　第345号</a>{link('0002', '省令（水産四二）')}{link('0002', '省令（水産四二）')}<a>号外　第3号</a>{link('0004', '告示')}"
    found = corpora.gazette_items(nodes(spark, day, html)).orderBy("place").collect()
    assert [(r["kind"], r["number"], r["title"], r["page"], r["agency"]) for r in found] == [("regular", "第345号", "省令（水産四二）", 2, "水産四二"), ("extra", "第3号", "告示", 4, None)]


def test_bills(spark):
    row = "<tr><td><span>灯台見学法の一部を改正する法律案</span></td><td>参議院で継続</td><td><a href='./keika/7AB02C1.htm'>経過</a></td><td><a href='./honbun/g.htm'>本文</a></td></tr>"
    found = corpora.bills(nodes(spark, "305", f"<table><tr><th>件名</th></tr>{row}{row}</table>")).collect()
    assert [tuple(r) for r in found] == [("305", "7AB02C1", "灯台見学法の一部を改正する法律案", "参議院で継続")]


def test_comment_pages(spark):
    html = "<table><tr><th>案件 番号</th><td>8802</td></tr><tr><th>根拠法令条項</th><td>灯台見学法第3条</td></tr></table><a onclick='show(id=8802)'>件</a>"
    page = nodes(spark, "p", html)
    case = corpora.comment_cases(page).first()
    assert (case["case_id"], case["legal_basis"], case["reception_end"]) == ("8802", "灯台見学法第3条", None)
    assert [(r["case_id"], r["title"]) for r in corpora.comment_list(page).collect()] == [("8802", "件")]


def test_circulars_and_ordinances(spark):
    html = "<h2>（開館）</h2><p class='indent1'><strong>２−5</strong>　本文</p><p class='indent1'>注</p><div class='article'>（開く日） 第一条 灯台は</div>"
    page = nodes(spark, "p", html)
    assert [(r["number"], r["caption"], r["text"]) for r in corpora.circular_items(page).collect()] == [("2-5", "（開館）", "本文")]
    assert [(r["article_no"], r["caption"]) for r in corpora.ordinance_articles(page).collect()] == [("第一条", "開く日")]


def test_layouts(spark):
    xhtml = '<page width="600" height="800"><word xMin="10" yMin="100" xMax="20" yMax="150">甲</word><word xMin="1" yMin="10" xMax="2" yMax="20">柱</word></page>'
    svg = '<g transform="matrix(1,0,0,-1,0,800)"><path d="M 10 100 L 10 200"/><path d="M 10 100 L 12 101"/></g><path d="M 0 5 L 50 5"/>'
    row = spark.createDataFrame([(xhtml, svg)], "x string, s string").select(corpora.layout_words("x").alias("w"), corpora.layout_rules("s").alias("r")).first()
    assert [tuple(w) for w in row["w"]] == [(1, 15.0, 100.0, 150.0, "甲")]
    assert [tuple(r) for r in row["r"]] == [("v", 10.0, 600.0, 700.0), ("h", 5.0, 0.0, 50.0)]


def test_pages_in_one_pass_equal_their_elements(spark):
    from codexflow.sources import listings

    cell = lambda kind, text: f"<td headers='{kind}'>{text}</td>"
    html = [
        "<th>案件 番号</th><td>1</td><th>案件番号</th><td>9</td><th>案件番号x</th><td>8</td><th>none</th><th>根拠法令条項</th><td></td>", "<th>a</th>", "", None,
        cell("KOMOKU", "議案種類") + cell("KOMOKU", "議案番号") + cell("NAIYO", "閣法") + cell("NAIYO", "") + cell("NAIYO", "over"),
        cell("KOMOKU", "議案番号") + cell("NAIYO", "") + cell("KOMOKU", "議案番号") + cell("NAIYO", "7") + cell("KOMOKU", "") + cell("NAIYO", "x") + cell("KOMOKU", "衆議院審議終了年月日／衆議院審議結果") + cell("NAIYO", "／可決"),
    ]
    pages = spark.createDataFrame(list(enumerate(html)), "k int, h string")
    nodes = markup.html_nodes(pages, "k", "h")
    for one, other in ((corpora.comment_pages(pages, "k", "h"), corpora.comment_cases(nodes)), (listings.bill_progress_pages(pages, "k", "h"), listings.bill_progress(nodes))):
        assert one.columns == other.columns and sorted(map(repr, one.collect())) == sorted(map(repr, other.collect())) and one.count()
        assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
