"""Scalar functions and filters over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.functions import dates, text
from codexflow.plans.base import Tables, query
from codexflow.sources.files import json_number


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso, '令和' || (case when year(o_orderdate) = 2019 then '元' else '' end) as mark, strftime(o_orderdate + interval 24 year, '%Y-%m-%d') as shifted from orders where year(o_orderdate) >= 1995")
def wareki_dates(t: Tables) -> DataFrame:
    year = F.year("o_orderdate")
    written = F.concat(F.lit("平成 "), F.translate((year - 1988).cast("string"), "0123456789", text.WIDE_DIGITS), F.lit("年"), F.month("o_orderdate"), F.lit("月"), F.day("o_orderdate"), F.lit("日"))
    later = F.concat(F.lit("令和"), F.when(year + 24 == 2019, "元").otherwise((year + 24 - 2018).cast("string")), F.lit("年"), F.month("o_orderdate"), F.lit("月"), F.day(F.col("o_orderdate") + F.expr("interval 24 years")), F.lit("日"))
    mark = F.concat(F.lit("令和"), F.when(year == 2019, "元").otherwise(""))
    return t.orders.filter(year >= 1995).select("o_orderkey", dates.written_date(written).alias("iso"), mark.alias("mark"), dates.written_date(later).alias("shifted"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as from_written, strftime(o_orderdate, '%Y-%m-%d') as from_iso, o_orderpriority as other, strftime(o_orderdate, '%Y-%m-%d') as from_era from orders")
def iso_normalise(t: Tables) -> DataFrame:
    written = F.concat(F.year("o_orderdate"), F.lit("年"), F.month("o_orderdate"), F.lit("月"), F.day("o_orderdate"), F.lit("日"))
    era = dates.era_date(F.lit("Heisei"), F.year("o_orderdate") - 1988, F.month("o_orderdate"), F.day("o_orderdate"))
    return t.orders.select("o_orderkey", dates.normal_date(written).alias("from_written"), dates.normal_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("from_iso"), dates.normal_date(F.col("o_orderpriority")).alias("other"), era.alias("from_era"))


@query("select o_orderkey, strftime(o_orderdate, '%a, %d %b %Y 00:00:00 +0000') as published from orders")
def rfc822(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.feed_date(F.to_date("o_orderdate")).alias("published"))


@query("select o_orderkey, case o_orderstatus when 'O' then 'shugiin' when 'F' then 'sangiin' else 'both' end as chamber, case when o_orderkey % 3 = 0 then true else false end as amending from orders")
def case_maps(t: Tables) -> DataFrame:
    name = F.when(F.col("o_orderstatus") == "O", "衆議院").when(F.col("o_orderstatus") == "F", "sangiin").otherwise("両議院")
    title = F.when(F.col("o_orderkey") % 3 == 0, "法律の一部を改正する法律").otherwise("告示")
    return t.orders.select("o_orderkey", text.chamber(name).alias("chamber"), text.is_amending_title(title).alias("amending"))


@query(r"select page_id, nullif(regexp_extract(url, '([0-9]+)', 1), '') as number, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') as host from pages")
def url_id_extract(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.nullif(F.regexp_extract("url", "([0-9]+)", 1), F.lit("")).alias("number"), F.nullif(F.regexp_extract("url", "^https?://([^/]+)", 1), F.lit("")).alias("host"))


@query("select o_orderkey, o_orderkey::varchar as digits, o_orderkey::varchar || '-5' as number from orders")
def fullwidth_digits(t: Tables) -> DataFrame:
    wide = F.translate(F.col("o_orderkey").cast("string"), text.DIGITS, text.WIDE_DIGITS)
    return t.orders.select("o_orderkey", text.digits_only(F.concat(F.lit("第"), wide, F.lit("号"))).alias("digits"), text.plain_number(F.concat(wide, F.lit("−５　"))).alias("number"))


@query("select p_partkey, nullif(trim(split_part(p_name, ' ', 1)), '') as before, nullif(trim(split_part(p_name, ' ', 2)), '') as after from part")
def split_slash(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.before_mark(F.col("p_name"), " ").alias("before"), text.after_mark(F.col("p_name"), " ").alias("after"))


@query("select conv_id, turn, role from conversations where role = 'user' and contains(lower(text), 'the')")
def filters_equality_text(t: Tables) -> DataFrame:
    return t.conversations.filter((F.col("role") == "user") & F.contains(F.lower("text"), F.lit("the"))).select("conv_id", "turn", "role")


@query("select doc_id from documents where (contains(lower(text), 'and the') or contains(lower(source), 'src1')) and lang in ('en', 'de')")
def filters_text(t: Tables) -> DataFrame:
    hit = F.contains(F.lower("text"), F.lit("and the")) | F.contains(F.lower("source"), F.lit("src1"))
    return t.documents.filter(hit & F.col("lang").isin("en", "de")).select("doc_id")


@query("""select doc_id, case when a > 0 then case when b > 1 then '…' else '' end || substr(text, b, e - b + 1) || case when e < length(text) then '…' else '' end end as stretch
from (select doc_id, text, a, greatest(a - 60, 1) as b, least(a + 6 + 100, length(text)) as e from (select doc_id, text, instr(lower(text), 'the and') as a from documents where text is not null))""")
def text_context(t: Tables) -> DataFrame:
    return t.documents.filter("text is not null").select("doc_id", text.context(F.col("text"), "the and").alias("stretch"))


@query("select event_id, json_extract(props, '$.k')::bigint as k from events where json_extract(props, '$.k') is not null")
def json_props(t: Tables) -> DataFrame:
    return t.events.select("event_id", json_number(F.get_json_object("props", "$.k")).alias("k")).filter("k is not null")


@query("""with b as (select item_id, list_distinct([substr(text, i, 2) for i in range(1, length(text))]) as g from benchmark)
select x.item_id as a, y.item_id as b, round(len(list_intersect(x.g, y.g)) / (len(x.g) + len(y.g) - len(list_intersect(x.g, y.g))), 6) as jaccard from b x join b y on y.item_id = x.item_id + 1""")
def jaccard_bigrams(t: Tables) -> DataFrame:
    left = t.benchmark.select(F.col("item_id").alias("a"), F.col("text").alias("x"))
    right = t.benchmark.select(F.col("item_id").alias("b"), F.col("text").alias("y"))
    met = left.join(right, F.col("b") == F.col("a") + 1)
    return met.select("a", "b", F.round(text.bigram_jaccard(F.col("x"), F.col("y")), 6).alias("jaccard"))


@query(r"select doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) as squeezed_md5, md5(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;'), '''', '&apos;')) as escaped_md5 from documents where text is not null")
def text_cleaning(t: Tables) -> DataFrame:
    docs = t.documents.filter("text is not null")
    return docs.select("doc_id", F.md5(text.squeeze(F.col("text")).cast("binary")).alias("squeezed_md5"), F.md5(text.escape_markup(F.col("text")).cast("binary")).alias("escaped_md5"))
