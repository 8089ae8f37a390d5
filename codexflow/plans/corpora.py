"""Index rows and feeds of the corpora, made of the driver's tables; texts compared and linked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.operators import corpora, gazette, linking, textdiff
from codexflow.plans.base import Tables, query


def _said(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _day(col: str = "o_orderdate") -> Column:
    return F.date_format(col, "yyyy-MM-dd")


DAY = "strftime(o_orderdate, '%Y-%m-%d')"


@query("""select o_custkey as law_id, 'a' || o_orderkey as article_id, 'law' || o_custkey || ' no' || o_custkey as heading, '第' || o_orderkey || '条 ' || o_orderpriority || ' ' || case when o_orderstatus = 'O' then '約款' else '規則' end || chr(10) || o_orderstatus || case when o_orderstatus = 'O' then chr(10) || '契約 約款' else '' end as content from orders""")
def index_law_rows(t: Tables) -> DataFrame:
    first = F.when(F.col("o_orderstatus") == "O", "約款").otherwise("規則")
    paragraphs = F.array(F.struct(F.lit("1").alias("paragraph_no"), first.alias("text")), F.struct(F.lit("2").alias("paragraph_no"), F.col("o_orderstatus").alias("text")))
    article = F.struct(_said("a", F.col("o_orderkey")).alias("article_id"), _said("第", F.col("o_orderkey"), "条").alias("article_no"), F.col("o_orderpriority").alias("caption"), paragraphs.alias("paragraphs"))
    laws = t.orders.groupBy(F.col("o_custkey").alias("law_id")).agg(F.collect_list(article).alias("articles"))
    named = laws.select("law_id", _said("law", F.col("law_id")).alias("title"), _said("no", F.col("law_id")).alias("law_num"), "articles")
    return corpora.law_rows(named, {"契約": ["約款"], "_x": ["規則"]})


@query("select conv_id, turn, text as speech, 'c' || conv_id as committee from conversations where length(trim(coalesce(text, ''))) > 0 and conv_id % 3 > 0")
def index_speech_rows(t: Tables) -> DataFrame:
    speeches = t.conversations.select(F.col("conv_id").alias("meeting_id"), "turn", F.col("text").alias("speech"))
    meetings = t.conversations.filter("conv_id % 3 > 0").select(F.col("conv_id").alias("meeting_id"), _said("c", F.col("conv_id")).alias("committee"), _said("d", F.col("turn")).alias("date"))
    return corpora.speech_rows(speeches, meetings).select(F.col("meeting_id").alias("conv_id"), "turn", "speech", "committee")


@query(f"select {DAY} as date, 't' || o_orderkey as title, case when o_orderkey % 2 = 0 then 'p' || o_orderkey else 'issue' end as pdf_url, case when o_orderkey % 3 > 0 then 'L' || o_custkey end as law_id from orders where o_orderkey % 7 > 0")
def index_gazette_rows(t: Tables) -> DataFrame:
    linked = F.when(F.col("o_orderkey") % 3 > 0, F.array(F.struct(_said("L", F.col("o_custkey")).alias("law_id")), F.struct(F.lit("L0").alias("law_id")))).otherwise(F.array().cast("array<struct<law_id:string>>"))
    title = F.when(F.col("o_orderkey") % 7 > 0, _said("t", F.col("o_orderkey"))).otherwise("")
    item = F.struct(title.alias("title"), F.lit(1).alias("page"), F.when(F.col("o_orderkey") % 2 == 0, _said("p", F.col("o_orderkey"))).otherwise("").alias("pdf_url"), linked.alias("linked_laws"), F.lit("x").alias("amend_text"))
    days = t.orders.groupBy(_day().alias("date")).agg(F.array(F.struct(F.lit("issue").alias("pdf_url"), F.collect_list(item).alias("items"))).alias("issues"))
    return corpora.gazette_rows(days).select("date", "title", "pdf_url", "law_id")


@query("select c_mktsegment as tax, c_custkey::varchar as number, c_name as text from customer where c_custkey % 5 > 0")
def index_circular_rows(t: Tables) -> DataFrame:
    item = F.struct(F.col("c_custkey").cast("string").alias("number"), F.lit("c").alias("caption"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_name")).alias("text"))
    sets = t.customer.groupBy(F.col("c_mktsegment").alias("tax")).agg(F.lit("L").alias("parent_law_id"), F.collect_list(item).alias("items"))
    return corpora.circular_rows(sets).select("tax", "number", "text")


@query(f"""select {DAY} as date, 'law' || o_orderkey as title, '/laws/' || o_custkey as link, case o_orderstatus when 'O' then '新規' when 'F' then '廃止' else 'modified' end as summary from orders
where {DAY} in (select distinct {DAY} as d from orders order by d desc limit 14) and o_orderkey % 4 > 0""")
def feed_of_laws(t: Tables) -> DataFrame:
    change = F.when(F.col("o_orderstatus") == "O", "added").when(F.col("o_orderstatus") == "F", "repealed").otherwise("modified")
    updates = t.orders.select(_day().alias("date"), F.col("o_custkey").cast("string").alias("law_id"), F.when(F.col("o_orderkey") % 4 > 0, _said("law", F.col("o_orderkey"))).alias("title"), change.alias("change_type"))
    odd = updates.limit(1).withColumn("date", F.lit("soon"))
    return corpora.law_feed(updates.union(odd)).select("date", "title", "link", "summary")


@query(f"""select case when o_orderstatus = 'O' then '2099-01-01' else {DAY} end as date, 'case' || o_orderkey as title, '/pubcomment/' || o_orderkey as link,
nullif(concat_ws(' · ', case when o_orderstatus = 'O' then '意見募集中（締切）' end, case when o_orderkey % 2 = 0 then '関連: 法' || o_custkey end), '') as summary from orders""")
def feed_of_comments(t: Tables) -> DataFrame:
    cases = t.orders.select(F.col("o_orderkey").cast("string").alias("case_id"), _said("case", F.col("o_orderkey")).alias("title"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("status"), F.lit("2099-01-01").alias("reception_end"), _day().alias("result_published"), F.when(F.col("o_orderkey") % 2 == 0, _said("法", F.col("o_custkey"))).alias("related_law_name"))
    return corpora.comment_feed(cases).select("date", "title", "link", "summary")


@query(f"""select {DAY} as date, 'g' || o_orderkey as title, 'u' || o_orderkey as link, 'を加える' || o_orderkey as summary from orders where {DAY} in (select distinct {DAY} as d from orders order by d desc limit 30) and o_orderkey % 3 > 0""")
def feed_of_gazettes(t: Tables) -> DataFrame:
    items = t.orders.select(_day().alias("date"), _said("g", F.col("o_orderkey")).alias("title"), _said("u", F.col("o_orderkey")).alias("pdf_url"), F.when(F.col("o_orderkey") % 3 > 0, _said("を加える", F.col("o_orderkey"))).alias("amend_text"))
    return corpora.gazette_feed(items).select("date", "title", "link", "summary")


@query(f"select {DAY} as date, 'b' || o_orderkey as title, concat_ws(' · ', '閣法', nullif(case when o_orderkey % 2 = 0 then 's' else '' end, ''), 'e') as summary from orders where o_orderkey % 3 > 0")
def feed_of_bills(t: Tables) -> DataFrame:
    bills = t.orders.select(F.col("o_orderkey").alias("bill_id"), _said("b", F.col("o_orderkey")).alias("title"), F.lit("閣法").alias("bill_type"), F.when(F.col("o_orderkey") % 2 == 0, "s").otherwise("").alias("status"), F.lit("e").alias("latest_event"), F.when(F.col("o_orderkey") % 3 > 0, _day()).alias("latest_date"))
    return corpora.bill_feed(bills).select("date", "title", "summary")


@query(f"select o_orderkey as item, '〇告示' || chr(10) || '漁港規則' || o_orderkey || 'の一部を次のように改める。' as amend_text, 'unknown' as amend_format from orders where o_orderkey % 2 = 0")
def gazette_amendments(t: Tables) -> DataFrame:
    title = F.when(F.col("o_orderkey") % 2 == 0, _said("漁港規則", F.col("o_orderkey"), "の一部を改正する省令（水産）")).otherwise("港の開放")
    items = t.orders.select(F.col("o_orderkey").alias("issue"), F.col("o_orderkey").alias("item"), title.alias("title"), F.lit(1).alias("page"))
    pages = t.orders.select(F.col("o_orderkey").alias("issue"), F.lit(1).alias("page"), _said("官\n〇公告\n別件に改める。次のように。\n〇告示\n漁港規則", F.col("o_orderkey"), "の一部を次のように改める。").alias("text"))
    return gazette.amendment_texts(items, pages).select("item", "amend_text", F.when(F.col("amend_format").isNotNull(), "unknown").alias("amend_format"))


@query("""with e as (select p_partkey as event, p_size || p_type as date, p_name as core from part where p_partkey % 2 = 0),
i as (select p_size || p_type as date, p_name as core from part where p_partkey % 2 = 1)
select event, case when max((e.core = i.core or (least(length(e.core), length(i.core)) >= 4 and (contains(e.core, i.core) or contains(i.core, e.core))))::int) = 1 then true end as linked from e left join i using (date) group by event""")
def gazette_linked_events(t: Tables) -> DataFrame:
    day = F.concat(F.col("p_size").cast("string"), F.col("p_type"))
    events = t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("event"), day.alias("date"), F.col("p_name").alias("title"))
    items = t.part.filter("p_partkey % 2 = 1").select(day.alias("date"), F.lit(1).alias("issue"), F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))
    return gazette.linked_events(events, gazette.item_matches(events, items)).select("event", F.col("kanpo.linked").alias("linked"))


@query("select doc_id, regexp_extract_all(text, 'other|there|the|and') as words from documents where regexp_matches(text, 'other|there|the|and')")
def linked_spans(t: Tables) -> DataFrame:
    hits = linking.find_patterns(t.documents.filter("text is not null"), "doc_id", "text", ["the", "other", "there", "and"])
    return textdiff.linked_spans(hits).select(F.col("id").alias("doc_id"), F.transform("spans", lambda s: s["pattern"]).alias("words"))


@query("select l_orderkey, l_linenumber, l_partkey, p_name from lineitem join part on p_partkey = l_partkey where contains('notice ' || l_orderkey || chr(10) || p_name, 'cold widget') and l_linenumber = 1")
def procurement_link(t: Tables) -> DataFrame:
    rows = t.lineitem.filter("l_linenumber = 1").join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    texts = rows.select(F.struct("l_orderkey", "l_linenumber", "l_partkey", "p_name").alias("key"), _said("notice ", F.col("l_orderkey"), "\n", F.col("p_name")).alias("text"))
    return linking.patterns_held(texts, "key", "text", ["cold widget", "no such law"]).select("id.*")


@query("""select o_orderkey, ['-' || 'a', '=' || o_orderkey || 'x', '+' || 'y'] as ops from orders""")
def compared_texts(t: Tables) -> DataFrame:
    pairs = t.orders.select("o_orderkey", _said("a", F.col("o_orderkey"), "x").alias("a"), _said(F.col("o_orderkey"), "xy").alias("b"))
    mark = lambda o: F.concat(F.when(o["op"] == "equal", "=").when(o["op"] == "delete", "-").otherwise("+"), o["text"])
    return textdiff.compared_texts(pairs, "o_orderkey", "a", "b").select("o_orderkey", F.transform("ops", mark).alias("ops"))
