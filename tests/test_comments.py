"""Comment cases: cards of lists, labelled rows, attachments."""

import random

from codexflow.sources import comments, markup

CARD = """<ul class="other egovui-list-comment-list">
<li><h2><a class="egovui-link">灯台見学法案 に関する結果</a></h2><span>結果公示</span>
<div class="egovui-link-area-cursor" onClick="f('/pcm/1040?CLASSNAME=P&amp;id=8802&amp;Mode=1')"></div>
<div class="egovui-comment-detail"><span>案件番号</span><span>77</span></div>
<div class="egovui-comment-detail"><span>結果の公示日</span>2031年2月3日</div><div class="egovui-comment-detail"><span>結果公示日</span>2031年2月4日</div>
<div class="egovui-comment-detail"><span>所管省庁</span><span>水産庁</span></div><ul><li>inner</li></ul></li>
<li><div class="egovui-comment-detail"><span>案件番号</span> 78 </div><div class="egovui-comment-detail"><span>受付締切日時</span></div></li>
<li><h2><a class="egovui-link">without an id</a></h2></li></ul>
<div class="egovui-comment-detail"><span>所管省庁</span><span>outside</span></div>"""

CASE = """<h1 class='egovui-article-title'>見学の件</h1><table class='egovui-normal-horizontal'><tr><th>案の 公示日</th><td></td></tr><tr><th>意見募集開始日</th><td>2031年1月1日</td></tr>
<tr><th>根拠法令条項</th><td>灯台見学法第3条</td></tr><tr><th>根拠法令条項</th><td>again</td></tr><tr><th>所管省庁</th><td>水産庁灯台課</td></tr><tr><th>提出意見数</th><td>1,204件</td></tr><tr><td>no label</td></tr></table>
<table><tr><th>カテゴリー</th><td>another table</td></tr></table><a class='x file' href='/a.pdf'>甲</a><a href='https://b.example/pcm/download?i=1'></a><a class='file' href=''>none</a><a href='/c'>none</a>"""


def nodes(spark, *html):
    return markup.html_nodes(spark.createDataFrame(list(enumerate(html)), "id int, html string"), "id", "html")


def test_upto_is_the_last_place_inside(spark):
    rows = markup.parse_nodes("<ul><li>a<br></li><li><p>b<p>c</li></ul><img><div><i>")
    assert [(r["tag"], r["place"], r["upto"]) for r in rows] == [("ul", 0, 5), ("li", 1, 2), ("br", 2, 2), ("li", 3, 5), ("p", 4, 5), ("p", 5, 5), ("img", 6, 6), ("div", 7, 8), ("i", 8, 8)]


def test_cards(spark):
    found = sorted(map(tuple, comments.cards(nodes(spark, CARD, None, "", "<ul class='egovui-list-comment-list'></ul>")).collect()))
    assert found == [(0, "78", "", None, None, None, None), (0, "8802", "灯台見学法案 に関する結果", "水産庁", None, None, "2031年2月4日")]


def test_case(spark):
    found = {r["id"]: r for r in comments.cases(nodes(spark, CASE, None, "<p>x</p>", "<table class='egovui-normal-horizontal'><tr><th>命令等の題名</th><td>令</td></tr><tr><th>提出意見数</th><td>99999999999</td></tr></table>"), "https://a.example").collect()}
    case = found[0]
    assert (case["title"], case["reception_start"], case["category"], case["opinion_count"]) == ("見学の件", "2031年1月1日", None, 1204)
    assert (case["related_law_name"], case["ministry"], case["responsible_office"]) == ("灯台見学法", "水産庁", "水産庁灯台課")
    assert [tuple(a) for a in case["attachments"]] == [("甲", "https://a.example/a.pdf"), ("添付", "https://b.example/pcm/download?i=1")]
    assert sorted(found) == [0, 2, 3] and (found[2]["title"], found[2]["attachments"], found[2]["opinion_count"]) == ("", [], None)
    assert (found[3]["title"], found[3]["opinion_count"]) == ("令", None)


def test_cards_of_pages_that_change_from_run_to_run(spark):
    """Cards in another order whenever the page is made: a value must not come to the card of another run's page."""

    def made(batches):
        for pdf in batches:
            cards = [f"<li><h2><a class='egovui-link'>t{k}</a></h2><div class='egovui-comment-detail'><span>案件番号</span>{k}</div></li>" for k in range(300)]
            random.SystemRandom().shuffle(cards)
            yield pdf.assign(html="<ul class='egovui-list-comment-list'>" + "".join(cards) + "</ul>")

    pages = spark.range(2).mapInPandas(made, "id long, html string")
    found = comments.cards(markup.html_nodes(pages, "id", "html")).collect()
    assert len(found) == 600 and all(r["title"] == f"t{r['case_id']}" for r in found)


def test_cases_parse_a_page_once(spark):
    found = comments.cases(nodes(spark, CASE), "https://a.example")
    assert found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("MapInArrow") == 1


def test_cases_in_one_pass_equal_their_elements(spark):
    parts = [
        "<table class='x egovui-normal-horizontal'>", "<table>", "</table>", "<tr>", "</tr>", "<tr><th>命令等の題名</th><td>令</td></tr>", "<th>提出 意見数</th>", "<td>1,204件</td>", "<th>根拠法令条項</th>", "<td>甲法第3条</td>", "<td></td>",
        "<h1 class='egovui-article-title'>", "件</h1>", "<a class='file' href='/a.pdf'>甲</a>", "<a href='https://b.example/pcm/download?i=1'></a>", "<a class='files' href='/c'>none</a>", "<th>所管省庁</th><td>水産庁灯台課</td>", "<b>&lt;", "text",
    ]
    rng = random.Random(4)
    html = [CASE, None, "", "text", "<p>x</p>"] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(600)]
    html += ["<table class='egovui-normal-horizontal'><tr>" + page for page in html[5:]]
    pages = spark.createDataFrame(list(enumerate(html)), "id int, html string")
    one, other = comments.case_pages(pages, "id", "html", "https://a.example"), comments.cases(markup.html_nodes(pages, "id", "html"), "https://a.example")
    assert one.columns == other.columns and sorted(map(repr, one.collect())) == sorted(map(repr, other.collect())) and one.filter("opinion_count is not null").count() > 20
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()


def test_cases_of_orders_are_not_read_in_one_task(spark):
    from codexflow.plans.registry import QUERIES

    found = QUERIES["comment_attachments"](spark, "/root/testdata/sf0.001")
    assert found.selectExpr("spark_partition_id() as task").distinct().count() > 4
