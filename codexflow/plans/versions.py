"""Version histories, with orders as the versions of a customer's record and lines as its articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.operators import textdiff, versions
from codexflow.plans.base import Tables, query

DATES = ["1996-01-01", "1998-06-30", "2001-01-01"]
SQL_ORDERS = "(select *, strftime(o_orderdate, '%Y-%m-%d') as day from orders)"


def _day() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd")


@query(f"""select c.o_custkey, d.as_of, arg_max(o.o_orderkey, struct_pack(a := o.day, b := -o.o_orderkey)) as o_orderkey, max(o.day) as day
from (select distinct o_custkey from orders) c cross join (select unnest({DATES}) as as_of) d
left join {SQL_ORDERS} o on o.o_custkey = c.o_custkey and o.day <= d.as_of group by all""")
def asof_order_per_customer(t: Tables) -> DataFrame:
    held = t.orders.select("o_custkey", "o_orderkey", _day().alias("day"))
    found = versions.as_of(held, DATES, "o_custkey", F.col("day"), F.col("o_orderkey"))
    return found.select("o_custkey", "as_of", "version.o_orderkey", "version.day")


@query(f"""select c.o_custkey, d.as_of, arg_max(o.o_orderkey, struct_pack(a := o.key, b := -o.o_orderkey)) as o_orderkey
from (select distinct o_custkey from orders) c cross join (select unnest({DATES}) as as_of) d
left join (select *, case when o_orderstatus = 'O' then strftime(o_orderdate - interval 90 day, '%Y-%m-%d') else day end as key from {SQL_ORDERS}) o
on o.o_custkey = c.o_custkey and o.key <= d.as_of group by all""")
def asof_include_unenforced(t: Tables) -> DataFrame:
    promulgated = F.date_format(F.col("o_orderdate") - F.expr("interval 90 days"), "yyyy-MM-dd")
    held = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "O", promulgated).otherwise(_day()).alias("key"))
    return versions.as_of(held, DATES, "o_custkey", F.col("key"), F.col("o_orderkey")).select("o_custkey", "as_of", "version.o_orderkey")


@query("select o_custkey, o_orderkey, lag(o_orderkey) over w as prev_o_orderkey, lag(o_totalprice) over w as prev_o_totalprice from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)")
def adjacent_pairs(t: Tables) -> DataFrame:
    held = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    found = versions.neighbours(held, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])
    return found.select("o_custkey", "o_orderkey", "prev_o_orderkey", "prev_o_totalprice")


@query("select o_orderkey, case when row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1 then 'added' else 'modified' end as change from orders")
def first_vs_modified(t: Tables) -> DataFrame:
    held = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    found = versions.neighbours(held, "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey"])
    return found.select("o_orderkey", F.when(F.col("prev_o_orderkey").isNull(), "added").otherwise("modified").alias("change"))


@query("select o_custkey, o_orderkey, o_orderstatus from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def current_version(t: Tables) -> DataFrame:
    held = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return versions.current(held, "o_custkey", F.struct("o_orderdate", "o_orderkey")).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("select o_custkey, coalesce(arg_max(o_orderkey, struct_pack(a := o_orderdate, b := o_orderkey)) filter (o_orderstatus = 'F'), arg_max(o_orderkey, struct_pack(a := o_orderdate, b := o_orderkey))) as o_orderkey from orders group by o_custkey")
def current_with_status(t: Tables) -> DataFrame:
    return versions.current_by_status(t.orders, "o_custkey", F.struct("o_orderdate", "o_orderkey"), F.col("o_orderstatus") == "F", "o_orderkey")


_SIDE = "select l_partkey, l_linenumber, max(l_quantity) as q, max(l_returnflag) as f from lineitem where {} group by all"
_EARLY, _LATE = "l_shipdate < timestamp '1998-01-01'", "l_shipdate >= timestamp '1998-01-01'"
_DIFF = f"""select coalesce(a.l_partkey, b.l_partkey) as l_partkey, coalesce(a.l_linenumber, b.l_linenumber)::bigint as l_linenumber,
case when a.l_partkey is null then 'added' when b.l_partkey is null then 'removed' when a.q = b.q and a.f = b.f then 'unchanged' else 'modified' end as change
from ({_SIDE.format(_EARLY)}) a full join ({_SIDE.format(_LATE)}) b on a.l_partkey = b.l_partkey and a.l_linenumber = b.l_linenumber"""


def _diff(t: Tables) -> DataFrame:
    sides = [t.lineitem.filter(side).groupBy("l_partkey", "l_linenumber").agg(F.max("l_quantity").alias("q"), F.max("l_returnflag").alias("f")) for side in (_EARLY, _LATE)]
    return versions.keyed_diff(*sides, ["l_partkey", "l_linenumber"], ["q", "f"])


@query(_DIFF)
def keyed_diff_fullouter(t: Tables) -> DataFrame:
    return _diff(t).select("l_partkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "change")


@query("select l_partkey, " + ", ".join(f"count(*) filter (change = '{c}') as {c}" for c in ("added", "removed", "modified", "unchanged")) + f" from ({_DIFF}) group by l_partkey")
def diff_summary(t: Tables) -> DataFrame:
    return versions.diff_summary(_diff(t), ["l_partkey"])


@query("select l_partkey, " + ", ".join(f"coalesce(list_sort(list(l_linenumber) filter (change = '{c}')), []) as {c}" for c in ("added", "removed", "modified")) + f" from ({_DIFF}) group by l_partkey")
def diff_article_ids(t: Tables) -> DataFrame:
    ids = lambda c: F.array_sort(F.collect_list(F.when(F.col("change") == c, F.col("l_linenumber").cast("long")))).alias(c)
    return _diff(t).groupBy("l_partkey").agg(*[ids(c) for c in ("added", "removed", "modified")])


@query("select doc_id, p::bigint as place, case when old is null then 'added' when new is null then 'removed' when old = new then 'unchanged' else 'modified' end as change from (select coalesce(a.doc_id, b.doc_id) as doc_id, coalesce(a.p, b.p) as p, a.line as old, b.line as new from (select doc_id, unnest(range(len(l))) as p, unnest(l) as line from (select doc_id, string_split(text, chr(10)) as l from documents)) a full join (select doc_id, unnest(range(len(l))) as p, unnest(l) as line from (select doc_id, string_split(lower(text), chr(10)) as l from documents)) b on a.doc_id = b.doc_id and a.p = b.p)")
def positional_diff(t: Tables) -> DataFrame:
    def side(text):
        lines = t.documents.filter("text is not null").select("doc_id", F.posexplode(F.split(text, "\n")).alias("place", "line"))
        return lines.withColumn("number", F.lit(None).cast("string"))

    found = versions.paragraph_diff(side(F.col("text")), side(F.lower("text")), "doc_id", "number", "place", "line")
    return found.select("doc_id", F.expr("cast(substring(key, 2) as bigint)").alias("place"), "change")


def _pairs(t: Tables, parts: int | None = None) -> DataFrame:
    """Documents of one beginning: each with the one of the next smaller id; in so many parts, which stay as they are, however few bytes they have."""
    texts = t.documents.filter("text is not null").select("doc_id", "text")
    # The neighbours are found by ids alone; texts are joined to the pairs.
    ids = texts.select("doc_id", F.xxhash64(F.left("text", F.lit(40))).alias("head"))
    pairs = versions.neighbours(ids, "head", [F.col("doc_id")], ["doc_id"]).filter("prev_doc_id is not null").select("doc_id", "prev_doc_id")
    before = texts.select(F.col("doc_id").alias("prev_doc_id"), F.col("text").alias("prev_text"))
    held = pairs.join(before, "prev_doc_id")
    if parts:
        held, texts = held.repartition(parts, "doc_id"), texts.repartition(parts, "doc_id")
    return held.join(texts, "doc_id").select("doc_id", "prev_text", "text")


@query()
def text_diff_chars(t: Tables) -> DataFrame:
    # The time of a pair is the product of its sizes: by bytes alone all pairs would come into a few tasks.
    parts = 4 * int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return textdiff.diff_texts(_pairs(t, parts), "doc_id", "prev_text", "text")


@query("""with p as (select doc_id, lag(text) over (partition by substr(text, 1, 40) order by doc_id) as a, text as b from documents where text is not null),
q as (select doc_id, a, b, least(length(a), length(b)) as short from p where a is not null),
r as (select *, (select coalesce(max(i), 0) from range(1, (select max(length(text)) + 1 from documents)) t(i) where i <= short and left(a, i) = left(b, i)) as prefix from q),
s as (select *, least((select coalesce(max(i), 0) from range(1, (select max(length(text)) + 1 from documents)) t(i) where i <= short and right(a, i) = right(b, i)), short - prefix) as suffix from r)
select doc_id, prefix::bigint as prefix, suffix::bigint as suffix, substr(a, (prefix + 1)::bigint, (length(a) - prefix - suffix)::bigint) as removed, substr(b, (prefix + 1)::bigint, (length(b) - prefix - suffix)::bigint) as added from s""")
def coarse_diff(t: Tables) -> DataFrame:
    found = _pairs(t).select("doc_id", textdiff.coarse_diff(F.col("prev_text"), F.col("text")).alias("d"))
    return found.select("doc_id", F.col("d.prefix").cast("long").alias("prefix"), F.col("d.suffix").cast("long").alias("suffix"), "d.removed", "d.added")


@query()
def lcs_align(t: Tables) -> DataFrame:
    lines = _pairs(t).select("doc_id", F.split("prev_text", "\n").alias("old"), F.split("text", "\n").alias("new"))
    return textdiff.align_rows(lines, "doc_id", "old", "new")


@query("""select o_orderkey, o_custkey, source, o_totalprice from (select *, row_number() over (partition by o_orderkey order by rank desc) as n from (
select o_orderkey, o_custkey, 'prebuilt' as source, 0 as rank, o_totalprice from orders where o_orderstatus <> 'O'
union all select o_orderkey, o_custkey, 'public', 1, o_totalprice * 2 from orders where o_orderstatus <> 'F')) where n = 1""")
def history_merge(t: Tables) -> DataFrame:
    cols = lambda name, price: ["o_orderkey", "o_custkey", F.lit(name).alias("source"), price.alias("o_totalprice")]
    low = t.orders.filter("o_orderstatus <> 'O'").select(*cols("prebuilt", F.col("o_totalprice")))
    high = t.orders.filter("o_orderstatus <> 'F'").select(*cols("public", F.col("o_totalprice") * 2))
    return versions.merge_histories(low, high, ["o_orderkey"], "o_custkey")


@query(f"""with v as (select o_custkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as p, day, o_orderpriority as s from {SQL_ORDERS}),
b as (select o_custkey, arg_max(struct_pack(p := p, s := s), struct_pack(d := day, p := p)) as b from v where day <= '2000-01-01' group by o_custkey),
a as (select b.o_custkey, coalesce(max(v.p) filter (v.s <> b.b.s), max(v.p)) as a from b join v on v.o_custkey = b.o_custkey and v.p < b.b.p and v.p >= b.b.p - 15 group by b.o_custkey)
select b.o_custkey, b.b.p::bigint as b, a.a::bigint as a from b left join a using (o_custkey)""")
def default_pair(t: Tables) -> DataFrame:
    place = F.expr("row_number() over (partition by o_custkey order by o_orderdate, o_orderkey)").cast("long")
    held = t.orders.select("o_custkey", place.alias("p"), _day().alias("day"), F.col("o_orderpriority").alias("s"))
    return versions.default_pair(held, "o_custkey", F.col("day"), F.col("s"), "p", "2000-01-01")


@query("select left(sha256(text), 12) as revision_id, count(*) as n_documents, min(doc_id) as first_doc_id from documents where text is not null group by 1")
def sha_revision_ids(t: Tables) -> DataFrame:
    held = t.documents.filter("text is not null").select("doc_id", F.left(F.sha2("text", 256), F.lit(12)).alias("revision_id"))
    return held.groupBy("revision_id").agg(F.count("*").alias("n_documents"), F.min("doc_id").alias("first_doc_id"))


@query("select count(*) as new_documents from (select distinct sha256(text) as h from documents where source like 'src1%' and text is not null) where h not in (select sha256(text) from documents where source not like 'src1%' and text is not null)")
def content_dedup(t: Tables) -> DataFrame:
    hashed = t.documents.filter("text is not null").select("source", F.sha2("text", 256).alias("h"))
    late = F.startswith(F.col("source"), F.lit("src1"))
    fresh = versions.unseen(hashed.filter(late).select("h"), hashed.filter(~late), ["h"])
    return fresh.agg(F.count("*").alias("new_documents"))


@query("select o_orderstatus, count(*) as revisions, count(distinct o_custkey) as baseline, (count(distinct o_custkey) >= 100 and count(*) * 2 < count(distinct o_custkey)) as shrunk from orders group by 1")
def shrink_guard(t: Tables) -> DataFrame:
    counted = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("revisions"), F.count_distinct("o_custkey").alias("baseline"))
    return counted.withColumn("shrunk", versions.shrunk(F.col("revisions"), F.col("baseline")))
