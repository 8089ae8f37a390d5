"""Lists and details of corpora, read from JSON and HTML that is put together from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.functions import gazette
from codexflow.operators import segments
from codexflow.plans.base import Tables, query
from codexflow.sources import comments, corpora, files, listings, markup


def _said(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _key() -> Column:
    return F.col("o_orderkey")


def _pages(t: Tables, *html: str | Column, parts: int | None = None) -> DataFrame:
    rows = t.orders.repartition(parts, "o_orderkey") if parts else t.orders
    return rows.select(F.col("o_orderkey").alias("key"), _said(*html).alias("html"))


def _parts(t: Tables) -> int:
    """Tasks for pages: they take far more time than the bytes of the rows say that they are made of."""
    return 4 * int(t.spark.conf.get("spark.sql.shuffle.partitions"))


def _nodes(t: Tables, *html: str | Column) -> DataFrame:
    return markup.html_nodes(_pages(t, *html), "key", "html")


@query("""select 'm' || o_orderkey as meeting_id, 213 as session, 'shugiin' as house, 5 as speech_count from orders
union all select 'x' || o_orderkey, 214, 'sangiin', 2 from orders union all select 'z' || o_orderkey, 3, '', 0 from orders""")
def meeting_lists(t: Tables) -> DataFrame:
    json = _said('{"meetingRecord":[{"issueID":"m', _key(), '","session":213,"nameOfHouse":"衆議院","numberOfSpeech":5},{"meetingId":"x', _key(), '","session":"214","nameOfHouse":"参議院","speechRecord":[{},{}]},{"session":1},{"issueID":"n"},{"issueID":"z', _key(), '","session":3}]}')
    return listings.meeting_list(t.orders.select(json.alias("j")), "j").select("meeting_id", "session", "house", "speech_count")


@query("""select 'm' || o_orderkey as meeting_id, 213 as session, 'shugiin' as house, 's' || o_orderkey as speech_id, 'said ' || o_orderkey as speech from orders""")
def meeting_speeches(t: Tables) -> DataFrame:
    json = _said('{"meetingRecord":[{"issueID":"m', _key(), '","session":"213","nameOfHouse":"衆議院","speechRecord":[{"speechID":"s', _key(), '","speech":"said ', _key(), '"},{"speechID":"","speech":"y"}]},{"issueID":"second"}]}')
    return files.meeting_rows(t.orders.select(json.alias("j")), "j").select("meeting_id", "session", "house", "speech_id", "speech")


@query("select o_orderkey::varchar as law_id, 'r' || i as law_revision_id, i::int as place, case i when 0 then o_orderpriority end as category from orders, (values (0), (1)) v(i)")
def revision_metadata(t: Tables) -> DataFrame:
    json = _said('{"law_info":{"law_id":"', _key(), '"},"revisions":[{"law_revision_id":"r0","category":"', F.col("o_orderpriority"), '"},{"law_revision_id":"r1"}]}')
    return files.revision_rows(t.orders.select(json.alias("j")), "j").select("law_id", "law_revision_id", "place", "category")


@query("select '01' as area, o_orderkey::varchar as value, '2020' as time from orders")
def statistic_values(t: Tables) -> DataFrame:
    json = _said('{"GET_STATS_DATA":{"STATISTICAL_DATA":{"DATA_INF":{"VALUE":[{"@area":"01","@time":"2020","$":"', _key(), '"},{"@area":"02","$":""}]}}}}')
    return files.statistic_rows(t.orders.select(json.alias("j")), "j").select("area", "value", "time")


@query("select area, count(*) as n from (select '0' || (o_orderkey % 7) as area from orders) group by area")
def statistic_index(t: Tables) -> DataFrame:
    json = _said('{"GET_STATS_DATA":{"STATISTICAL_DATA":{"DATA_INF":{"VALUE":[{"@area":"0', _key() % 7, '","$":"1"}]}}}}')
    return files.statistic_rows(t.orders.select(json.alias("j")), "j").groupBy("area").agg(F.count("*").alias("n"))


@query("select o_orderkey as id, '閣法' as bill_type, o_orderkey::varchar as number, '件' || o_orderkey as title, 217 as session, case when o_orderkey % 2 = 0 then '甲委' else '乙委' end as committee, '可決' as result, '令和 7年' as promulgated, '7' as law_num from orders")
def bill_progress_pages(t: Tables) -> DataFrame:
    pair = lambda label, *value: [f"<tr><td headers='KOMOKU'>{label}</td><td headers='NAIYO'>", *value, "</td></tr>"]
    lower = F.when(_key() % 2 == 0, "令和／甲委").otherwise("／")
    html = [*pair("議案種類", "閣法"), *pair("議案番号", _key()), *pair("議案件名", "件", _key()), *pair("議案件名", "other"), *pair("議案提出回次", "217回"), *pair("衆議院付託年月日／衆議院付託委員会", lower)]
    html += [*pair("参議院付託年月日／参議院付託委員会", "令和／乙委"), *pair("", "x"), *pair("衆議院審議終了年月日／衆議院審議結果", "／可決"), *pair("公布年月日／法律番号", "令和 7年／7"), *pair("議案提出者", "")]
    return listings.bill_progress_pages(_pages(t, "<table>", *html, "</table>", parts=_parts(t)), "key", "html").drop("submitter", "parties")


@query("select o_orderkey as id, 'b' || o_orderkey as bill_id, '題' || o_orderkey as title, '審議中' as status from orders")
def bill_lists(t: Tables) -> DataFrame:
    row = ["<tr><td><span>題", _key(), "</span></td><td>審議中</td><td><a href='./keika/b", _key(), ".htm'>経過</a></td></tr>"]
    return corpora.bills(_nodes(t, "<table><tr><th>件名</th></tr>", *row, *row, "</table>")).select("id", "bill_id", "title", "status")


@query("select o_orderkey as id, 'r_50_' || o_orderkey || '.html' as page from orders union all select o_orderkey, 'r_50_a.html' from orders")
def ordinance_index_pages(t: Tables) -> DataFrame:
    return listings.ordinance_pages(_nodes(t, "<a href='x/r_50_a.html'>a</a><a href='r_50_a.html'>b</a><a href='r_50_", _key(), ".html'>c</a><a href='r_51_a.html'>d</a><a>e</a>"))


@query("select '121002_g' || o_orderkey as ordinance_id, 'g' || o_orderkey || '.html' as file, '条例' || o_orderkey as title from orders")
def ordinance_lists(t: Tables) -> DataFrame:
    code = F.lit(listings.MUNICIPALITIES[0][0])
    return listings.ordinance_list(_nodes(t, "<a href='../reiki_honbun/g", _key(), ".html'>条例", _key(), "</a><a href='../reiki_honbun/g", _key(), ".html'>again</a><a href='reiki_honbun/e.html'></a><a href='x/y.html'>z</a>"), code)


@query("""select o_orderkey as id, '例' || o_orderkey as title, case when o_orderkey % 2 = 0 then '条例第' || o_orderkey || '号' end as number, case when o_orderkey % 2 = 0 then ['第一条', '第二条'] else [null] end as articles from orders""")
def ordinance_details(t: Tables) -> DataFrame:
    blocks = F.when(_key() % 2 == 0, _said("<p>条例第", _key(), "号</p><div class='article'>第一条 甲</div><div class='article'>第二条 規則第9号</div>")).otherwise("<p>text</p>")
    found = listings.ordinance_documents(_nodes(t, "<html><head><title>例", _key(), "</title></head><body>", blocks, "</body></html>"))
    return found.select("id", "title", "number", F.col("articles.article_no").alias("articles"))


@query("select o_orderkey as id, '/law/kihon/x/' || (o_orderkey % 90 + 1) || '/02.htm' as url from orders")
def circular_contents(t: Tables) -> DataFrame:
    page = ["/law/kihon/x/", _key() % 90 + 1, "/02.htm"]
    return listings.circular_pages(_nodes(t, "<a href='", *page, "#a-1'>1</a><a href='", *page, "'>2</a><a href='/law/kihon/x/zenbun/01.htm'>3</a><a href='/law/other/1/2.htm'>4</a>"))


@query("select o_orderkey as id, '2-' || o_orderkey as number, '（開館）' as caption, '本文' || o_orderkey as text from orders")
def circular_texts(t: Tables) -> DataFrame:
    found = corpora.circular_items(_nodes(t, "<h2>（開館）</h2><p class='indent1'><strong>２−", _key(), "</strong>　本文", _key(), "</p><p class='indent1'>注</p>"))
    return found.select("id", "number", "caption", "text")


@query("""with s as (select * from (values ('shotoku', '340AC0000000033'), ('hojin', '340AC0000000034'), ('shohi', '363AC0000000108'), ('sozoku', '325AC0000000073'), ('hyoka', '325AC0000000073')) v(tax, parent_law_id)),
o as (select o_orderkey, case when o_orderkey % 6 < 3 then 'shotoku' when o_orderkey % 6 = 3 then 'sozoku' when o_orderkey % 6 = 4 then 'hyoka' else 'unknown' end as tax from orders)
select parent_law_id, count(distinct s.tax) as sets, count(o_orderkey) as items, min(o_orderkey) as first from s left join o using (tax) group by 1""")
def circular_sets(t: Tables) -> DataFrame:
    """Circulars by the law that their set explains: a law of two sets, sets without circulars, circulars of no known set."""
    tax = F.when(_key() % 6 < 3, "shotoku").when(_key() % 6 == 3, "sozoku").when(_key() % 6 == 4, "hyoka").otherwise("unknown")
    # Items are counted by set before they meet the few sets, and those by law.
    items = t.orders.select(tax.alias("tax"), "o_orderkey").groupBy("tax").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"))
    joined = listings.circular_sets(t.spark).join(items, "tax", "left")
    return joined.groupBy("parent_law_id").agg(F.count("*").alias("sets"), F.coalesce(F.sum("n"), F.lit(0)).alias("items"), F.min("least").alias("first"))


@query("""select code, '千葉市' as name, code || '_g' || o_orderkey as ordinance_id from (select o_orderkey, case o_orderkey % 3 when 0 then '121002' when 1 then '999999' end as code from orders) where code = '121002'""")
def municipalities_known(t: Tables) -> DataFrame:
    """Ordinances of the municipalities that are known and wanted, with their names; others and those without a code are left out."""
    code = F.when(_key() % 3 == 0, "121002").when(_key() % 3 == 1, "999999")
    ordinances = t.orders.select(code.alias("code"), F.concat(code, F.lit("_g"), _key().cast("string")).alias("ordinance_id"))
    return ordinances.join(F.broadcast(listings.municipalities(t.spark, ["121002", "999999"])), "code").select("code", "name", "ordinance_id")


@query("select o_orderkey as id, '審議会' || o_orderkey as committee from orders")
def council_lists(t: Tables) -> DataFrame:
    return listings.committees(_nodes(t, "<a href='/shingi/", _key(), "'>審議会", _key(), "</a><a href='/shingi/e'> </a><a href='/x'>y</a>")).select("id", "committee")


@query("select o_orderkey as id, 'moj_甲会_gijiroku' || o_orderkey as minutes_id, '第' || o_orderkey || '回' as title, 'https://a.example/k/gijiroku' || o_orderkey || '.html' as detail_url from orders")
def council_minutes(t: Tables) -> DataFrame:
    found = listings.minutes_list(_nodes(t, "<a href='/k/gijiroku", _key(), ".html'>第", _key(), "回</a><a href='k/minutes.html'></a><a href='k/z.html'>z</a>"), F.lit("moj"), F.lit("甲会"), "https://a.example/")
    return found.select("id", "minutes_id", "title", "detail_url")


@query("select o_orderkey as id, case when o_orderkey % 2 = 0 then 'main ' || o_orderkey || ' f' else 'head body f' end as body_text, ['a' || o_orderkey || '.pdf'] as attachments from orders")
def council_documents(t: Tables) -> DataFrame:
    inner = F.when(_key() % 2 == 0, _said("<div class='x contents'>main ", _key())).otherwise("<div>body")
    return listings.minutes_documents(_nodes(t, "<body><p>head </p>", inner, " <a href='a", _key(), ".pdf'>f</a></div></body>"))


@query("select o_orderkey as id, o_orderkey::varchar as case_id, '法第3条' as legal_basis from orders")
def comment_details(t: Tables) -> DataFrame:
    found = corpora.comment_pages(_pages(t, "<table><tr><th>案件 番号</th><td>", _key(), "</td></tr><tr><th>案件番号</th><td>9</td></tr><tr><th>根拠法令条項</th><td>法第3条</td></tr></table>"), "key", "html")
    return found.select("id", "case_id", "legal_basis")


@query("select o_orderkey as id, o_orderkey::varchar as case_id, '件' || o_orderkey as title from orders")
def comment_lists(t: Tables) -> DataFrame:
    return corpora.comment_list(_nodes(t, "<a onclick='show(id=", _key(), ")'>件", _key(), "</a><a href='?id=", _key(), "'>again</a><a>x</a>"))


@query("""select o_orderkey // 20 as page, case when o_orderstatus = 'F' then 'n' || o_orderkey else o_orderkey::varchar end as case_id, case when o_orderkey % 5 > 0 then o_orderpriority || ' の件' else '' end as title,
case when o_orderpriority <> '5-LOW' then o_orderpriority end as ministry, case when o_orderstatus = 'O' then strftime(o_orderdate, '%Y-%m-%d') end as reception_start,
case when o_orderstatus <> 'O' then strftime(o_orderdate, '%Y-%m-%d') end as result_published from orders where not (o_orderstatus = 'F' and o_orderkey % 7 = 0)""")
def comment_cards(t: Tables) -> DataFrame:
    """Cards of list pages of twenty: with and without handlers, titles and labels; a nested list and a stray label don't count."""
    day, status = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus")
    detail = lambda label, *value: _said('<div class="x egovui-comment-detail"><span>', label, "</span>", *value, "</div>")
    card = F.concat(
        F.lit("<li>"), F.when(_key() % 5 > 0, _said('<h2>\n<a class="egovui-link">', F.col("o_orderpriority"), "  の件</a></h2>")).otherwise('<a class="egovui-link">no heading</a>'),
        F.when(status != "F", _said("<div class='egovui-link-area-cursor' onclick=\"go('?CLASSNAME=P&amp;id=", _key(), "&amp;Mode=1')\"></div>")).otherwise(""),
        F.when((status == "F") & (_key() % 7 > 0), detail("案件番号", "<span>n", _key(), "</span>")).otherwise(""),
        F.when(status == "O", detail("案の公示日", " ", day, " ")).when(_key() % 2 == 0, detail("結果の公示日", day)).otherwise(detail("結果公示日", "<b>", day, "</b>")),
        detail("所管省庁", F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("<span>"), F.col("o_orderpriority"), F.lit("</span>"))).otherwise("")), F.lit("<ul><li>inner</li></ul></li>"),
    )
    lists = t.orders.groupBy(F.expr("o_orderkey div 20").alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(_key().alias("k"), card.alias("c")))), lambda x: x["c"]), "\n").alias("cards"))
    html = _said("<ul><li>none</li></ul><ul class='egovui-list-comment-list'>", F.col("cards"), "</ul>", detail("所管省庁", "outside"))
    return comments.cards(markup.html_nodes(lists.select("page", html.alias("html")), "page", "html")).select(F.col("id").alias("page"), "case_id", "title", "ministry", "reception_start", "result_published")


_FILES = "(select o_orderkey, o_orderdate, o_orderpriority, count(l_linenumber) as n, coalesce(list(l_partkey order by l_linenumber, l_partkey) filter (l_linenumber is not null), []) as parts from orders left join lineitem on l_orderkey = o_orderkey group by all)"


@query(f"""select o_orderkey as id, case when o_orderkey % 3 > 0 then '件' || o_orderkey when o_orderkey % 2 = 0 then '令' || o_orderkey else '' end as title, case when o_orderkey % 4 > 0 then '法' || o_orderkey % 9 end as related_law_name,
case when o_orderkey % 5 > 0 then '水産庁' else 'office ' || o_orderpriority end as ministry, strftime(o_orderdate, '%Y-%m-%d') as reception_start, case when n > 0 then n end as opinion_count,
case when n > 0 then array_to_string([case when x % 3 > 0 then '別紙' || x else '添付' end || ' ' || case when x % 2 = 0 then 'https://a.example/pcm/download?id=' || x else 'https://b.example/' || x || '.pdf' end for x in parts], ';') else '' end as files from {_FILES}""")
def comment_attachments(t: Tables) -> DataFrame:
    """Cases with as many attachments as their order has lines, under labels that differ; other tables and links don't count."""
    row = lambda label, *value: _said("<tr><th>", label, "</th><td>", *value, "</td></tr>")

    def link(part: Column) -> Column:
        number = part.cast("string")
        name = F.when(part % 3 > 0, F.concat(F.lit("別紙"), number)).otherwise("")
        return F.when(part % 2 == 0, _said("<a href='/pcm/download?id=", number, "'>", name, "</a>")).otherwise(_said("<a class='file' href='https://b.example/", number, ".pdf'>", name, "</a>"))

    # Lines and orders meet in the parts in which the pages are read.
    parts = _parts(t)
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p")).alias("l")).repartition(parts, "o_orderkey")
    links = lines.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: link(x["p"])), "<a href='/else'>x</a>").alias("links"))
    cases = t.orders.repartition(parts, "o_orderkey").join(links, "o_orderkey", "left")
    html = F.concat(
        F.when(_key() % 3 > 0, _said("<h1 class='egovui-article-title'>件", _key(), "</h1>")).otherwise("<h1>other</h1>"), F.lit("<table class='egovui-normal-horizontal'>"),
        F.when(_key() % 2 == 0, row("命令等の題名", "令", _key())).otherwise(""), F.when(_key() % 4 > 0, row("根拠法令 条項", "法", _key() % 9, "第", _key(), "条（甲）")).otherwise(row("根拠法令条項", "")),
        F.when(_key() % 5 > 0, row("（所管省庁・部局名等）", "水産庁灯台課")).otherwise(row("所管省庁", "office ", F.col("o_orderpriority"))), row("意見募集開始日", F.date_format("o_orderdate", "yyyy-MM-dd")), row("意見募集開始日", "again"),
        row("提出意見数", F.coalesce(F.concat(F.col("n").cast("string"), F.lit("件")), F.lit("なし"))), F.lit("</table><table><tr><th>カテゴリー</th><td>other</td></tr></table><a class='file' href=''>none</a>"), F.coalesce("links", F.lit("")),
    )
    found = comments.case_pages(cases.select(_key().alias("key"), html.alias("html")), "key", "html", "https://a.example")
    files_ = F.array_join(F.transform("attachments", lambda f: F.concat_ws(" ", f["name"], f["url"])), ";")
    return found.select("id", "title", "related_law_name", "ministry", "reception_start", "opinion_count", files_.alias("files"))


@query("select o_orderkey as id, 'regular' as kind, '第' || o_orderkey || '号' as number, '告示（甲）' as title, (o_orderkey % 90)::int as page, '甲' as agency from orders")
def gazette_contents(t: Tables) -> DataFrame:
    page = F.lpad((_key() % 90).cast("string"), 4, "0")
    link = ["<a href='", _key(), "/", _key(), page, "f.html'>告示（甲） ", _key() % 90, "</a>"]
    nodes = markup.html_nodes(t.orders.select(_key().cast("string").alias("key"), _said(*link, "<a>本紙　第", _key(), "号</a>", *link, *link).alias("html")), "key", "html")
    return corpora.gazette_items(nodes).select(F.col("id").cast("long").alias("id"), "kind", "number", "title", "page", "agency")


@query("select l_orderkey as listing, l_linenumber as number, l_partkey as item from (select *, min(l_linenumber) filter (l_returnflag = 'R') over (partition by l_orderkey) as stop from lineitem) where stop is null or l_linenumber < stop")
def listing_pages(t: Tables) -> DataFrame:
    items = F.collect_list(F.when(F.col("l_returnflag") != "R", F.col("l_partkey")))
    empty = F.count_if(F.col("l_returnflag") == "R") > 0
    pages = t.lineitem.groupBy(F.col("l_orderkey").alias("listing"), F.col("l_linenumber").alias("number")).agg(F.when(empty, F.array().cast("array<bigint>")).otherwise(items).alias("items"))
    return listings.before_empty(pages, "listing", "number", "items")


@query("select o_orderkey, o_custkey, c_name from orders join customer on c_custkey = o_custkey where c_custkey % 3 > 0")
def session_fetched(t: Tables) -> DataFrame:
    bodies = t.customer.filter("c_custkey % 3 > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    once = listings.fetched(t.orders.select("o_custkey"), bodies, "o_custkey")
    return t.orders.select("o_orderkey", "o_custkey").join(once, "o_custkey").select("o_orderkey", "o_custkey", "c_name")


@query("select c_custkey::varchar as law_id, c_name as body from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')")
def updates_of_lists(t: Tables) -> DataFrame:
    xml = _said("<R><Result><Code>", F.when(F.col("o_orderstatus") == "F", "0").otherwise("1"), "</Code></Result><LawId>", F.col("o_custkey"), "</LawId><LawID>none</LawID></R>")
    bodies = t.customer.select(F.col("c_custkey").cast("string").alias("law_id"), F.col("c_name").alias("body"))
    return listings.update_batch(t.orders.select(xml.alias("x")), bodies, "x")


@query("select c_custkey from customer where c_mktsegment = 'BUILDING' order by c_custkey limit 20")
def bulk_of_category(t: Tables) -> DataFrame:
    return listings.bulk(t.customer, "c_mktsegment", "BUILDING", "c_custkey", 20).select("c_custkey")


@query("""select o_orderkey as id, 0 as segment, null as heading, '前' || o_orderkey as text from orders union all select o_orderkey, 1, '（定義等）', '（定義等）' || chr(10) || '甲' from orders
union all select o_orderkey, 2, '附則', '附則' from orders""")
def band_segments(t: Tables) -> DataFrame:
    text = _said("前", _key(), "\n　（定義等）\n甲\n\n附則\n")
    found = segments.headed_segments(t.orders.select("o_orderkey", text.alias("text")), "o_orderkey", "text", gazette.is_row_heading)
    return found.select("id", F.col("segment").cast("int").alias("segment"), "heading", "text")


@query("""select o_orderkey as id, 0::bigint as row, '前文' || o_orderkey as preamble, '' as after, '' as before from orders where o_orderkey % 5 > 0
union all select o_orderkey, 1, '', '甲' || o_orderkey, '乙' || chr(10) || '改正前' from orders where o_orderkey % 5 > 0 union all select o_orderkey, 2, '', '丙', '' from orders where o_orderkey % 5 > 0""")
def before_and_after_rows(t: Tables) -> DataFrame:
    text = F.when(_key() % 5 > 0, _said("前文", _key(), "\n（傍線部分は改正部分）\n 改正後 \n甲", _key(), "\n改正前\n\n乙\n改正前\n改正後\n丙\n")).otherwise("改正後\nx")
    return segments.before_and_after(t.orders.select("o_orderkey", text.alias("text")), "o_orderkey", "text")


@query("select doc_id, instr(text, 'tion')::int as at from documents where text is not null")
def sequence_place(t: Tables) -> DataFrame:
    return t.documents.filter("text is not null").select("doc_id", F.locate("tion", "text").alias("at"))
