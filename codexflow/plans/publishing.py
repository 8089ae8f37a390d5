"""Feeds, calendars, facets and order-dependent reports over the star schema and ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.operators import publish, views, segments
from codexflow.plans.base import Tables, query
from codexflow.streaming import updates

_FEED_SQL = """select kind, date, title, link from (
select 'order' as kind, strftime(o_orderdate, '%Y-%m-%d') as date, o_orderpriority as title, '/orders/' || o_orderkey as link, 0 as seq from orders
union all select 'event', strftime(ts, '%Y-%m-%d'), event_type, '/events/' || event_id, 1 from events
union all select 'line', strftime(l_shipdate, '%Y-%m-%d'), l_returnflag, '/lines/' || l_orderkey || '/' || l_linenumber, 2 from lineitem)"""


def _sources(t: Tables) -> list[DataFrame]:
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias("date")
    return [
        t.orders.select(F.lit("order").alias("kind"), day("o_orderdate"), F.col("o_orderpriority").alias("title"), F.concat(F.lit("/orders/"), "o_orderkey").alias("link")),
        t.events.select(F.lit("event").alias("kind"), day("ts"), F.col("event_type").alias("title"), F.concat(F.lit("/events/"), "event_id").alias("link")),
        t.lineitem.select(F.lit("line").alias("kind"), day("l_shipdate"), F.col("l_returnflag").alias("title"), F.concat(F.lit("/lines/"), "l_orderkey", F.lit("/"), "l_linenumber").alias("link")),
    ]


@query(_FEED_SQL + " order by date desc, kind, seq, title, link limit 200")
def feed_union_topn(t: Tables) -> DataFrame:
    return publish.feed(_sources(t))


@query(f"select kind, count(*) as n from ({_FEED_SQL}) group by kind")
def feed_facets(t: Tables) -> DataFrame:
    a, b, c = _sources(t)
    return publish.facets(a.select("kind").union(b.select("kind")).union(c.select("kind")), "kind")


@query("select event_id, event_type, strftime(ts, '%Y-%m-%d') as day from events where strftime(ts, '%Y-%m-%d') in (select distinct strftime(ts, '%Y-%m-%d') as d from events order by d desc limit 14)")
def feed_topk_dates(t: Tables) -> DataFrame:
    return publish.newest_dates(t.events.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")), "day", 14)


def _entry_sql(summary: str) -> str:
    """An item of RSS of the columns ``kind``, ``date``, ``title`` and ``link``."""
    esc = lambda x: f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;')"
    return f"""'<item><title>' || {esc("'[' || kind || '] ' || title")} || '</title><link>/#' || link || '</link><guid isPermaLink="false">' || kind || ':' || date || ':' || link || '</guid><pubDate>'
|| strftime(date::date, '%a, %d %b %Y %H:%M:%S +0000') || '</pubDate>' || coalesce('<description>' || {esc(summary)} || '</description>', '') || '</item>'"""


@query(f"""select '<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>updates</title><description>all &amp; new</description><link>/feed</link><lastBuildDate>' || strftime(max(date)::date, '%a, %d %b %Y %H:%M:%S +0000') || '</lastBuildDate>'
|| string_agg({_entry_sql("null::varchar")}, '' order by date desc, kind, title, link) || '</channel></rss>' as value from ({_FEED_SQL} order by date desc, kind, seq, title, link limit 200)""")
def feed_rss(t: Tables) -> DataFrame:
    return publish.rss(publish.feed(_sources(t)), "updates", "/feed", "all & new")


@query(f"""with f as (select doc_id, 'doc' as kind, '20' || lpad((doc_id % 90 + 10)::varchar, 2, '0') || '-03-0' || (doc_id % 9 + 1) as date, coalesce(text, '') as title, '/d/' || doc_id as link, source as summary from documents)
select doc_id, sha256({_entry_sql("summary")}) as entry_sha256 from f""")
def rss_entries(t: Tables) -> DataFrame:
    """Every document's whole text as the title of an item, its source as the description."""
    day = F.concat(F.lit("20"), (F.col("doc_id") % 90 + 10).cast("string"), F.lit("-03-0"), (F.col("doc_id") % 9 + 1).cast("string"))
    rows = t.documents.select("doc_id", F.lit("doc").alias("kind"), day.alias("date"), F.col("text").alias("title"), F.concat(F.lit("/d/"), F.col("doc_id").cast("string")).alias("link"), F.col("source").alias("summary"))
    return rows.select("doc_id", F.sha2(publish.rss_entry(rows), 256).alias("entry_sha256"))


@query("select l_orderkey, l_linenumber::bigint as l_linenumber, date, basis from (select *, case when l_returnflag = 'R' then strftime(l_shipdate, '%Y-%m-%d') else strftime(l_shipdate + interval 30 day, '%Y-%m-%d') end as date, case when l_returnflag = 'R' then 'scheduled' else 'effective' end as basis from lineitem) where date > '1998-06-01' order by date, l_orderkey, l_linenumber limit 1000")
def enforcement_upcoming(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumns({
        "planned": F.when(F.col("l_returnflag") == "R", F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise(""),
        "effective": F.date_format(F.col("l_shipdate") + F.expr("interval 30 days"), "yyyy-MM-dd"),
        "key": F.struct("l_orderkey", "l_linenumber"),
    })
    found = publish.upcoming(lines, F.lit("1998-06-01"), F.col("planned"), F.col("effective"), "key")
    return found.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "date", "basis")


@query("select strftime(l_shipdate, '%Y-%m-%d') as date, list_sort(list(l_orderkey * 10 + l_linenumber)) as items, count(*) as n from lineitem group by 1")
def enforcement_groups(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"))
    return publish.grouped_by_date(lines, "date", F.col("item"))


@query("select strftime(d, '%Y-%m-%d') as day, coalesce(n, 0)::bigint as n from (select unnest(generate_series((select max(ts)::date from events) - interval 13 day, (select max(ts)::date from events)::timestamp, interval 1 day)) as d) left join (select ts::date as e, count(*) as n from events group by 1) on e = d::date")
def calendar_trend_14d(t: Tables) -> DataFrame:
    last = t.events.agg(F.max(F.to_date("ts"))).first()[0]
    found = publish.calendar(t.events, F.to_date("ts"), F.lit(last).cast("date"))
    return found.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


@query("select event_id, strftime(ts, '%Y-%m-%d') as day from events where strftime(ts, '%Y-%m-%d') in (select distinct strftime(ts, '%Y-%m-%d') as d from events order by d desc limit 3) order by day desc, event_id limit 8")
def recent_flatten(t: Tables) -> DataFrame:
    return publish.recent_rows(t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day")), "day", tie="event_id")


@query("select o_orderkey, row_number() over (order by (o_orderstatus = 'O') desc, case when o_orderstatus = 'O' then o_orderdate end asc nulls last, case when o_orderstatus <> 'O' then o_orderdate end desc nulls last, o_orderkey) as place from orders")
def conditional_sort_index(t: Tables) -> DataFrame:
    # Whether a case is open and its day, as one key that sorts like the order of the index.
    days = F.unix_date(F.to_date("o_orderdate"))
    lead = publish.open_first_key(F.col("o_orderstatus") == "O", days, days)
    return views.placed(t.orders, lead, [F.col("o_orderkey")], ascending=True).select("o_orderkey", "place")


@query("select n_name, last, row_number() over (order by last desc nulls last, n_name) as place from (select n_name, max(strftime(o_orderdate, '%Y-%m-%d')) filter (o_orderstatus = 'P') as last from nation left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by n_name)")
def nulls_last_sort(t: Tables) -> DataFrame:
    joined = t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    grouped = joined.groupBy("n_name").agg(F.max(F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("last"))
    return grouped.select("n_name", "last", F.expr("row_number() over (order by last desc nulls last, n_name)").cast("long").alias("place"))


@query()
def collated_sort(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name").withColumn("updated", F.lit(None).cast("string")).orderBy(*publish.by_title("updated", "p_name"), "p_partkey").select("p_partkey", "p_name")


@query("select strftime(o_orderdate, '%Y-%m-%d') as date, count(*) as n, sum(o_totalprice) as total from orders group by 1")
def updates_by_date(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


@query("select coalesce(max(strftime(o_orderdate, '%Y-%m-%d')), '1970-01-01') as latest from orders")
def latest_update(t: Tables) -> DataFrame:
    return t.orders.agg(F.coalesce(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd"), F.lit("1970-01-01")).alias("latest"))


@query("select user_id, event_id, arg.until::bigint as until from (select user_id, event_id, struct_pack(until := least(greatest(coalesce((select min(b.event_id) from events b where b.user_id = a.user_id and b.event_id > a.event_id) - 1, 1000000000), event_id), event_id + 24)) as arg from events a)")
def next_start_page(t: Tables) -> DataFrame:
    return segments.next_starts(t.events.select("user_id", "event_id"), "user_id", "event_id", F.lit(1_000_000_000)).select("user_id", "event_id", F.col("until").cast("long").alias("until"))


@query("select event_id, user_id, last_value(case when event_type = 'signup' then value end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as caption from events")
def carry_forward_caption(t: Tables) -> DataFrame:
    found = segments.carried(t.events, "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("value")), "caption")
    return found.select("event_id", "user_id", "caption")


_GAPS = "select l_partkey, l_extendedprice as v, coalesce(l_extendedprice - lag(l_extendedprice) over (partition by l_partkey order by l_extendedprice), 2001) > 2000 as new from lineitem"


@query(f"select l_partkey, cluster::bigint as cluster, round(min(v), 2) as least, round(max(v), 2) as most, count(*) as n from (select *, sum(new::int) over (partition by l_partkey order by v rows unbounded preceding) as cluster from ({_GAPS})) group by all")
def gap_clusters(t: Tables) -> DataFrame:
    found = segments.gap_clusters(t.lineitem, ["l_partkey"], "l_extendedprice", 2000.0)
    return found.select("l_partkey", F.col("cluster").cast("long").alias("cluster"), F.round("least", 2).alias("least"), F.round("most", 2).alias("most"), "n")


@query(r"select doc_id, place::bigint as place, sum(regexp_matches(line, '^[A-Z][a-z]*\.?$')::int) over (partition by doc_id order by place rows unbounded preceding)::bigint as segment from (select doc_id, unnest(range(len(l))) as place, unnest(l) as line from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents))")
def running_segments(t: Tables) -> DataFrame:
    found = segments.segment_numbers(t.documents, "doc_id", "text", r"^[A-Z][a-z]*\.?$")
    return found.select("doc_id", F.col("place").cast("long").alias("place"), F.col("segment").cast("long").alias("segment"))


@query("select p.p_partkey, b.band from part p join (select unnest(range(0, 50, 5)) as band) b on p.p_size >= b.band and p.p_size < b.band + 5 and p.p_retailprice >= 0 and p.p_retailprice < 100000")
def range_cell_join(t: Tables) -> DataFrame:
    points = t.part.select("p_partkey", F.lit(1).alias("page"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    cells = t.spark.range(0, 50, 5).select(F.col("id").alias("band"), F.lit(1).alias("page"), F.col("id").cast("double").alias("x0"), (F.col("id") + 5).cast("double").alias("x1"), F.lit(0.0).alias("y0"), F.lit(100000.0).alias("y1"))
    return segments.cells_of_points(points, F.broadcast(cells), "page").select("p_partkey", "band")


_SPANS = "(select o_custkey, epoch(o_orderdate)::bigint as b, epoch(o_orderdate)::bigint + 86400 * 400 as e from orders)"


@query(f"""with c as (select distinct a.o_custkey, a.b as cut from {_SPANS} a),
n as (select c.o_custkey, c.cut, (select count(*) from {_SPANS} s where s.o_custkey = c.o_custkey and s.b < c.cut and c.cut < s.e) as crossings from c)
select o_custkey, cut, crossings::bigint as crossings from n qualify row_number() over (partition by o_custkey order by crossings, cut) = 1""")
def min_crossing_cut(t: Tables) -> DataFrame:
    spans = t.orders.select("o_custkey", F.unix_timestamp("o_orderdate").alias("b")).withColumn("e", F.col("b") + 86400 * 400)
    found = segments.quietest_cut(spans, "o_custkey", "b", "e")
    return found.select("o_custkey", "cut", F.col("crossings").cast("long").alias("crossings"))


@query("""select conv_id, arg_max(turn, struct_pack(s := score, n := turn)) as turn, max(score) as score from
(select *, (contains(text, 'and')::int + contains(text, 'tion')::int) * 1000 + length(text) as score from conversations where text is not null) group by conv_id""")
def argmax_priority(t: Tables) -> DataFrame:
    found = segments.best_segment(t.conversations.filter("text is not null"), "conv_id", "text", "turn", ["and", "tion"])
    return found.select("conv_id", "turn", F.col("score").cast("long").alias("score"))


@query("select o_orderkey, strftime(greatest(o_orderdate, ship), '%Y-%m-%d') as date, case when o_orderdate >= ship or ship is null then 'ordered' else 'shipped' end as label from orders left join (select l_orderkey, max(l_shipdate) as ship from lineitem group by 1) on l_orderkey = o_orderkey")
def latest_event(t: Tables) -> DataFrame:
    ship = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("ship"))
    found = t.orders.select("o_orderkey", "o_orderdate").join(ship, "o_orderkey", "left").select("o_orderkey", publish.latest_event([("ordered", F.col("o_orderdate")), ("shipped", F.col("ship"))]).alias("e"))
    return found.select("o_orderkey", F.date_format("e.date", "yyyy-MM-dd").alias("date"), "e.label")


@query("select 'lang' as facet, lang as value from documents where lang is not null and lang <> '' group by all union all select 'status', o_orderstatus from orders where o_orderstatus <> '' group by all union all select 'type', event_type from events where event_type <> '' group by all")
def facet_distincts(t: Tables) -> DataFrame:
    part = lambda name, rows, c: publish.distinct_values(rows, c).select(F.lit(name).alias("facet"), F.col(c).alias("value"))
    return part("lang", t.documents, "lang").union(part("status", t.orders, "o_orderstatus")).union(part("type", t.events, "event_type"))


@query("select n_name, coalesce(nullif(s, ''), r_name, '') as label from (select n_name, n_regionkey, case when n_nationkey % 2 = 0 then n_name else '' end as s from nation) left join region on r_regionkey = n_regionkey")
def summary_enrichment(t: Tables) -> DataFrame:
    live = t.nation.select("n_name", "n_regionkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("").alias("label"))
    known = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("label"))
    return publish.enriched(live, known, "n_regionkey", ["label"]).select("n_name", "label")


@query("select user_id, strftime(d, '%Y-%m-%d') as day from (select user_id, unnest(generate_series(max(ts)::date - interval 3 day, least(max(ts)::date + interval 2 day, '2024-01-31'::date), interval 1 day)) as d from events group by user_id)")
def lookback_window_dates(t: Tables) -> DataFrame:
    last = t.events.groupBy("user_id").agg(F.to_date(F.max("ts")).alias("last"))
    today = F.least(F.date_add("last", 2), F.lit("2024-01-31").cast("date"))
    return last.select("user_id", F.explode(updates.dates_to_fetch(F.col("last"), today)).alias("d")).select("user_id", F.date_format("d", "yyyy-MM-dd").alias("day"))


@query("select user_id, (count(*) filter (event_type = 'error') > 0 or count(distinct event_id) <> count(*) or not bool_or(event_type = 'purchase')) as changed from events group by user_id")
def change_detection(t: Tables) -> DataFrame:
    counted = t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("new"), (F.count_distinct("event_id") != F.count("*")).alias("force"), F.bool_or(F.col("event_type") == "purchase").alias("complete"))
    return counted.select("user_id", updates.changed(F.col("force"), F.col("new"), F.col("complete")).alias("changed"))


@query("select strftime(time_bucket(interval 1 day, ts), '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def window_tumbling_ext(t: Tables) -> DataFrame:
    found = updates.tumbling(t.events, "ts", "1 day", ["event_type"], [F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")])
    return found.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total")


@query("""with g as (select user_id, ts, coalesce(ts - lag(ts) over (partition by user_id order by ts) >= interval 6 hour, true) as new from events),
s as (select user_id, ts, sum(new::int) over (partition by user_id order by ts rows unbounded preceding) as session from g)
select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as began, count(*) as n from s group by user_id, session""")
def window_session_ext(t: Tables) -> DataFrame:
    found = updates.sessions(t.events, "ts", "6 hours", ["user_id"], [F.count("*").alias("n")])
    return found.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("began"), "n")
