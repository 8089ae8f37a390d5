"""Filters, orders and counts of the site's pages, over orders, customers, documents and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.operators import publish, views
from codexflow.plans.base import Tables, query


def _day(col: str = "o_orderdate") -> Column:
    return F.date_format(col, "yyyy-MM-dd")


DAY = "strftime(o_orderdate, '%Y-%m-%d')"


@query("select c_custkey from customer where c_mktsegment = 'BUILDING' and (contains(lower(c_name), '00000012') or contains(c_nationkey::varchar, '00000012'))")
def view_ministry_and_text(t: Tables) -> DataFrame:
    return views.with_text(views.selected(t.customer, "c_mktsegment", ["BUILDING"]), "00000012", ["c_name", "c_nationkey"]).select("c_custkey")


@query("select p_partkey from part where contains(lower(p_name), 'cold') or contains(lower(p_type), 'cold')")
def view_items_by_text(t: Tables) -> DataFrame:
    return views.with_text(t.part, "COLD", ["p_name", "p_type"]).select("p_partkey")


@query("""select conv_id, len(turns)::int as n, turns from (select conv_id, coalesce(list(turn order by turn) filter (contains(lower(coalesce(text, '')), 'tion of')), []) as turns from conversations group by conv_id)""")
def view_opinions_by_text(t: Tables) -> DataFrame:
    turns = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    hits = turns.select("conv_id", views.matching_items(F.col("turns"), "TION of", ["text"]).alias("hits"))
    return hits.select("conv_id", F.size("hits").alias("n"), F.col("hits.turn").alias("turns"))


@query("select o_orderkey, list_filter([case when o_orderkey % 3 = 0 then '／' else 'p' end, case when o_orderstatus = 'O' then '' else o_orderstatus end, o_orderpriority], lambda x: x not in ('', '／')) as said from orders")
def view_bill_fields(t: Tables) -> DataFrame:
    pair = lambda label, value: F.struct(F.lit(label).alias("label"), value.alias("value"))
    fields = F.array(
        pair("a", F.when(F.col("o_orderkey") % 3 == 0, "／").otherwise("p")),
        pair("b", F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus"))),
        pair("c", F.col("o_orderpriority")),
    )
    return t.orders.select("o_orderkey", views.filled_fields(fields)["value"].alias("said"))


@query("select event_id, event_type from events where event_type in ('click', 'error')")
def view_kinds_chosen(t: Tables) -> DataFrame:
    return views.selected(t.events, "event_type", ["click", "error"]).select("event_id", "event_type")


@query("select event_id, event_type from events")
def view_kinds_all(t: Tables) -> DataFrame:
    return views.selected(t.events, "event_type", []).select("event_id", "event_type")


@query("select o_orderkey from orders where o_orderstatus = 'F' and o_orderkey % 2 = 0")
def view_linked_with_file(t: Tables) -> DataFrame:
    link = F.when(F.col("o_orderkey") % 5 != 1, F.struct((F.col("o_orderstatus") == "F").alias("linked"), F.when(F.col("o_orderkey") % 2 == 0, "u").otherwise("").alias("pdf_url")))
    whole = F.coalesce(link, F.struct((F.col("o_orderstatus") == "F").alias("linked"), F.when(F.col("o_orderkey") % 2 == 0, "u").alias("pdf_url")))
    return views.linked_with_file(t.orders.select("o_orderkey", whole.alias("kanpo"))).select("o_orderkey")


@query(f"select o_orderkey, row_number() over (order by {DAY} desc, o_orderkey) as place from orders")
def order_newest_first(t: Tables) -> DataFrame:
    return views.placed(t.orders, _day(), [F.col("o_orderkey")]).select("o_orderkey", "place")


@query("select o_orderkey, row_number() over (partition by o_custkey order by o_orderkey::varchar) as place from orders")
def order_bills_in_session(t: Tables) -> DataFrame:
    return views.ranked(t.orders, "o_custkey", [F.col("o_orderkey").cast("string")]).select("o_orderkey", "place")


@query("select o_orderkey, row_number() over (order by o_custkey desc, o_orderkey::varchar) as place from orders")
def order_sessions_newest(t: Tables) -> DataFrame:
    return views.placed(t.orders, F.col("o_custkey"), [F.col("o_orderkey").cast("string")]).select("o_orderkey", "place")


@query("select l_orderkey, l_linenumber, l_partkey, row_number() over (partition by l_orderkey order by l_discount desc, l_shipdate desc, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as place from lineitem")
def order_links_by_confidence(t: Tables) -> DataFrame:
    order = [F.col("l_discount").desc(), F.col("l_shipdate").desc(), *map(F.col, ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))]
    return views.ranked(t.lineitem, "l_orderkey", order).select("l_orderkey", "l_linenumber", "l_partkey", "place")


@query(f"select o_orderkey, day, row_number() over (partition by o_custkey order by day desc nulls last, o_orderkey) as place from (select *, case when o_orderkey % 4 = 0 then {DAY} when o_orderkey % 4 = 1 then '2001-02-03' end as day from orders)")
def order_timeline(t: Tables) -> DataFrame:
    dated = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, _day()).alias("a"), F.when(F.col("o_orderkey") % 4 < 2, "2001-02-03").otherwise("").alias("b"))
    return views.timeline(dated, "o_custkey", ["a", "b"], "o_orderkey").select("o_orderkey", "day", "place")


@query("select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) <= 3")
def order_targets_cut(t: Tables) -> DataFrame:
    return views.ranked(t.orders, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query(f"""with u as (select {DAY} as date, o_orderkey from orders where o_orderstatus = 'F'), d as (select distinct date from u order by date desc limit 14)
select * from u where date in (select date from d) union all select {DAY}, o_orderkey from orders where o_orderstatus = 'O' and {DAY} = (select max({DAY}) from orders) and {DAY} not in (select date from d)""")
def view_recent_updates(t: Tables) -> DataFrame:
    rows = t.orders.select(_day().alias("date"), "o_orderkey", "o_orderstatus")
    odd = rows.limit(1).select(F.lit("unknown").alias("date"), "o_orderkey", F.lit("F").alias("o_orderstatus"))
    newest = rows.agg(F.max("date").alias("newest"))
    latest = rows.filter(F.col("o_orderstatus") == "O").join(F.broadcast(newest), F.col("date") == F.col("newest"))
    return views.recent_updates(rows.filter(F.col("o_orderstatus") == "F").union(odd).drop("o_orderstatus"), latest.select("date", "o_orderkey"))


@query(f"select {DAY} as date, o_orderkey as number, o_orderstatus as kind from orders")
def view_gazette_flat(t: Tables) -> DataFrame:
    days = t.orders.groupBy(_day().alias("date")).agg(F.collect_list(F.struct(F.col("o_orderkey").alias("number"), F.col("o_orderstatus").alias("kind"))).alias("issues"))
    return views.flat_issues(days)


@query("""select article, direction, count(*) as n, min(other) as least, max(other) as most from (select l_orderkey as article, 'from' as direction, l_partkey as other from lineitem
union all select l_partkey, 'to', l_orderkey from lineitem) group by all""")
def refs_by_article(t: Tables) -> DataFrame:
    return views.references_by_article(t.lineitem, "l_orderkey", "l_partkey")


@query("select sum(n)::bigint as total from (select count(*) as n from orders where o_orderdate >= (select max(o_orderdate) from orders) - interval 13 day)")
def trend_total(t: Tables) -> DataFrame:
    last = t.orders.agg(F.max(F.to_date("o_orderdate")).alias("d")).first()["d"]
    return publish.calendar(t.orders, F.to_date("o_orderdate"), F.lit(last)).agg(F.sum("n").alias("total"))


@query("select lang, count(*) as n from documents group by lang")
def category_counts(t: Tables) -> DataFrame:
    return publish.facets(t.documents, "lang")


@query("select page_id, greatest(page_id % 9000, 17)::int as last from pages")
def gazette_last_page(t: Tables) -> DataFrame:
    link = lambda n: F.format_string("<a href='x%04df.html'>p</a>", n)
    html = F.concat(link((F.col("page_id") % 9000).cast("int")), F.lit("<p>9999</p>"), link(F.lit(17)))
    return t.pages.select("page_id", views.last_page(html).alias("last"))


@query("select case o_orderstatus when 'O' then 'open' else 'closed' end as status, count(*) as n from orders where o_orderstatus in ('O', 'F') group by all")
def case_status_counts(t: Tables) -> DataFrame:
    mode = F.when(F.col("o_orderstatus") == "O", "0").when(F.col("o_orderstatus") == "F", "1").otherwise("2")
    wanted = views.selected(t.orders.withColumn("mode", mode), "mode", views.modes_for("all"))
    return wanted.groupBy(views.case_status(F.col("mode")).alias("status")).agg(F.count("*").alias("n"))


@query("select o_orderkey, coalesce(case when o_orderkey % 2 = 0 then o_orderstatus end, c_mktsegment) as a, coalesce(case when o_orderkey % 3 = 0 then o_orderpriority end, c_name) as b from orders left join customer on c_custkey = o_custkey")
def detail_filled_from_list(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("a"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("b"))
    listed = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("a"), F.col("c_name").alias("b"))
    return views.filled_from(rows, listed, "k", ["a", "b"]).select("o_orderkey", "a", "b")


@query("select c_custkey, c_name, null::varchar as result, null::bigint as opinions, '2026-01-01T00:00:00Z' as fetched_at from customer")
def detail_of_open_cases(t: Tables) -> DataFrame:
    return views.detail_of_listed(t.customer, ["c_custkey", "c_name"], {"result": "string", "opinions": "long"}, F.lit("2026-01-01T00:00:00Z"))


@query("select o_orderkey, case o_orderkey % 10 when 1 then 'enactment' when 3 then 'amendment' when 8 then 'repeal' else 'snapshot' end as event from orders")
def event_types(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", views.event_type((F.col("o_orderkey") % 10).cast("string")).alias("event"))


@query("select event_id, strftime(date_trunc('minute', ts) + interval 9 hour, '%Y-%m-%d %H:%M') as shown from events")
def shown_in_zone(t: Tables) -> DataFrame:
    return t.events.select("event_id", views.shown_in(F.col("ts")).alias("shown"))


@query("select c_mktsegment, count(*) as n, count(distinct c_nationkey) as titles, min(c_nationkey) as first from customer group by all")
def index_by_municipality(t: Tables) -> DataFrame:
    return views.grouped_index(t.customer, "c_mktsegment", "c_nationkey")


@query("select o_custkey, count(*) as entries from orders group by all")
def cache_entries(t: Tables) -> DataFrame:
    return views.held(t.orders, "o_custkey")


@query("select o_custkey as id from orders union select c_custkey from customer")
def id_sets_united(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("id")).union(t.customer.select("c_custkey")).distinct()


@query(f"select o_orderkey, 'order:' || o_custkey || ':' || {DAY} as event_id, '/laws/' || o_custkey || '/r/' || o_orderkey as href, case o_orderstatus when 'O' then '法令' when 'F' then '官報' else 'P' end as label from orders")
def synthetic_ids(t: Tables) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "O", "law").when(F.col("o_orderstatus") == "F", "gazette").otherwise(F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", publish.event_id("order", F.col("o_custkey"), _day()).alias("event_id"), publish.href("laws", F.col("o_custkey"), F.lit("r"), F.col("o_orderkey")).alias("href"), publish.kind_label(kind).alias("label"))
