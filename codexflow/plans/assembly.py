"""Laws put together: customers are laws, their orders revisions, the orders' lines articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.operators import assembly, law_files, nested
from codexflow.plans.base import Tables, query
from codexflow.sources.workspace import workspace

#: Articles of a revision: lines by their number; lines of one number count as one article.
LINES = "(select o_custkey as law, o_orderkey as revision, l_linenumber as article, max(l_returnflag || l_linestatus || l_quantity::int) as body from lineitem join orders on o_orderkey = l_orderkey group by all)"
ORDER = "(select o_custkey as law, o_orderkey as revision, lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as prev from orders)"
CHANGES = f"""(with a as {LINES}, o as {ORDER}, n as (select * from a join o using (law, revision)), p as (select o.law, o.revision, a.article, a.body from o join a on a.law = o.law and a.revision = o.prev)
select law, revision, article, p.body as old, n.body as new, case when p.body is null then 'added' when n.body is null then 'removed' else 'modified' end as change
from n full join p using (law, revision, article) where n.body is distinct from p.body)"""


def _articles(t: Tables) -> DataFrame:
    body = F.concat("l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").cast("string"))
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return lines.groupBy(F.col("o_custkey").alias("law"), F.col("o_orderkey").alias("revision"), F.col("l_linenumber").alias("article")).agg(F.max(body).alias("body"))


def _revisions(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("law"), F.col("o_orderkey").alias("revision"), F.col("o_orderdate").alias("day"))


def _changes(t: Tables) -> DataFrame:
    order = assembly.revision_order(_revisions(t), "law", "revision", [F.col("day"), F.col("revision")])
    return assembly.article_changes(_articles(t), order, "law", "revision", "article", "body")


@query(f"select law, revision, article, change from {CHANGES}")
def revision_diffs(t: Tables) -> DataFrame:
    return _changes(t).select("law", "revision", "article", "change")


@query(f"select law, revision, change, count(*) as n from {CHANGES} group by all")
def revision_diff_index(t: Tables) -> DataFrame:
    return _changes(t).groupBy("law", "revision", "change").agg(F.count("*").alias("n"))


@query(f"""with a as {LINES}, o as (select o_custkey as law, max(o_orderkey) as revision, min(o_orderkey) as prev from orders group by 1 having count(*) > 1),
n as (select * from a join o using (law, revision)), p as (select o.law, o.revision, a.article, a.body from o join a on a.law = o.law and a.revision = o.prev)
select law, revision, article, case when p.body is null then 'added' when n.body is null then 'removed' else 'modified' end as change from n full join p using (law, revision, article) where n.body is distinct from p.body""")
def revision_pair_diff(t: Tables) -> DataFrame:
    pairs = _revisions(t).groupBy("law").agg(F.max("revision").alias("revision"), F.min("revision").alias("prev")).filter("revision <> prev")
    return assembly.pair_changes(_articles(t), "law", "revision", "article", "body", pairs).select("law", "revision", "article", "change")


@query(f"select law, revision, article, change from {CHANGES} where revision % 10 = 3")
def update_article_diff(t: Tables) -> DataFrame:
    wanted = _revisions(t).filter("revision % 10 = 3").select("law", "revision").union(_revisions(t).limit(1).select(F.lit(-1).cast("long"), F.lit(-1).cast("long")))
    return assembly.of_update(_changes(t), "law", "revision", wanted).select("law", "revision", "article", "change")


@query(f"""select law, revision, article, case change when 'added' then 'to' when 'removed' then 'from' end as side, case change when 'added' then new when 'removed' then old end as whole,
case when change = 'modified' then list_max([0] || [i for i in range(1, least(length(old), length(new)) + 1) if substr(old, 1, i) = substr(new, 1, i)])::int end as prefix from {CHANGES}""")
def diff_payloads(t: Tables) -> DataFrame:
    return assembly.payloads(_changes(t)).select("law", "revision", "article", F.col("whole.side").alias("side"), F.col("whole.text").alias("whole"), F.col("ends.prefix").alias("prefix"))


#: A line as an article of up to four paragraphs; one in twelve has a paragraph without a number.
_NESTED = """(select o_custkey as law, o_orderkey as revision, l_linenumber as article, arg_max({'no': l_returnflag, 'caption': l_linestatus, 'ps': list_filter([
{'no': '1', 'text': '品目' || l_suppkey % 7 || '番'}, {'no': case when l_suppkey % 12 > 0 then '2' end, 'text': '数量は' || l_quantity::int || '個とする。'}, case when l_quantity > 25 then {'no': '3', 'text': '割引' || (l_discount * 100)::int} end,
case when l_quantity > 40 then {'no': '4', 'text': '終わり'} end], lambda x: x is not null)}, concat_ws('|', l_partkey, l_suppkey, l_quantity::int, (l_discount * 100)::int, l_returnflag, l_linestatus)) as a from lineitem join orders on o_orderkey = l_orderkey group by all)"""
_NESTED_PAIRS = f"""a as {_NESTED}, o as {ORDER}, n as (select law, revision, article, a as new from a join o using (law, revision)),
p as (select o.law, o.revision, a.article, a.a as old from o join a on a.law = o.law and a.revision = o.prev),
c as (select law, revision, article, old, new, case when old is null then 'added' when new is null then 'removed' else 'modified' end as change from n full join p using (law, revision, article) where new is distinct from old),
m as (select *, len(list_filter(old.ps || new.ps, lambda x: x.no is null)) = 0 and len(old.ps) > 0 and len(new.ps) > 0 as numbered from c where change = 'modified'),
s as (select law, revision, article, 'modified' as article_change, no, case when q is null then 'added' when p is null then 'removed' when numbered and p.text = q.text or p.text = q.text and p.no is not distinct from q.no then 'unchanged' else 'modified' end as change, q.text as before, p.text as after from
(select law, revision, article, numbered, coalesce(p.no, case when p is null then q.no end) as no, p, q from
(select law, revision, article, numbered, i, new.ps[i] as p, case when numbered then list_filter(old.ps, lambda x: x.no = new.ps[i].no)[1] else old.ps[i] end as q from (select *, unnest(range(1, len(new.ps) + 1)) as i from m)
union all select law, revision, article, numbered, i, null, old.ps[i] from (select *, unnest(range(1, len(old.ps) + 1)) as i from m) where case when numbered then len(list_filter(new.ps, lambda x: x.no = old.ps[i].no)) = 0 else i > len(new.ps) end)))"""


def _nested_pairs(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    number = lambda c: F.col(c).cast("int").cast("string")
    paragraph = lambda no, *text: F.struct(no.alias("paragraph_no"), F.concat(*[F.lit(x) if isinstance(x, str) else x for x in text]).alias("text"))
    ps = F.array(
        paragraph(F.lit("1"), "品目", (F.col("l_suppkey") % 7).cast("string"), "番"),
        paragraph(F.when(F.col("l_suppkey") % 12 > 0, "2"), "数量は", number("l_quantity"), "個とする。"),
        F.when(F.col("l_quantity") > 25, paragraph(F.lit("3"), "割引", F.round(F.col("l_discount") * 100).cast("int").cast("string"))),
        F.when(F.col("l_quantity") > 40, paragraph(F.lit("4"), "終わり")),
    )
    article = F.struct(F.col("l_returnflag").alias("article_no"), F.col("l_linestatus").alias("caption"), F.array_compact(ps).alias("paragraphs")).cast(nested.ARTICLE)
    articles = lines.groupBy(F.col("o_custkey").alias("law"), F.col("o_orderkey").alias("revision"), F.col("l_linenumber").alias("number")).agg(F.max_by(article, F.concat_ws("|", "l_partkey", "l_suppkey", number("l_quantity"), F.round(F.col("l_discount") * 100).cast("int").cast("string"), "l_returnflag", "l_linestatus")).alias("article"))
    order = assembly.revision_order(_revisions(t), "law", "revision", [F.col("day"), F.col("revision")])
    later = articles.join(order.select("law", "revision"), ["law", "revision"])
    earlier = order.filter("prev is not null").join(articles.withColumnRenamed("revision", "prev"), ["law", "prev"]).drop("prev")
    return nested.article_pairs(earlier, later, ["law", "revision", "number"])


@query(f"""with {_NESTED_PAIRS} select law, revision, article as number, article_change, no as paragraph_no, change, before, after from s where change <> 'unchanged'
union all select law, revision, article, change, null, null, old.no || old.caption, new.no || new.caption from c""")
def nested_diffs(t: Tables) -> DataFrame:
    """Heads of changed articles, and their changed paragraphs with both texts, put together again from the operations."""
    changes = nested.diff_articles(_nested_pairs(t))
    said = lambda side: F.concat(f"{side}.article_no", f"{side}.caption")
    none = F.lit(None).cast("string")
    row = lambda number, change, before, after: F.struct(number.alias("paragraph_no"), change.alias("change"), before.alias("before"), after.alias("after"))
    side = lambda p, kind, name: F.when(p.change == kind, p.text).when(p.change == "modified", nested.text_of(p.text_diff, name))
    steps = F.transform(F.filter("paragraphs", lambda p: p.change != "unchanged"), lambda p: row(p.paragraph_no, p.change, side(p, "removed", "old"), side(p, "added", "new")))
    # Head and paragraphs come from one pass: two readers of the changes would each run the diff.
    head = F.array(row(none, none, said("from_article"), said("to_article")))
    rows = F.when(F.col("paragraphs").isNull(), head).otherwise(F.concat(head, steps))
    return changes.select("law", "revision", "number", F.col("change").alias("article_change"), F.explode(rows).alias("r")).select("law", "revision", "number", "article_change", "r.*")


@query("select o_custkey as law, o_orderkey as revision, case when o_orderkey in (select l_orderkey from lineitem where l_linenumber = 1) then 'laws/' || o_custkey || '/revisions/' || o_orderkey || '.json' end as path from orders")
def version_bodies(t: Tables) -> DataFrame:
    bodies = t.lineitem.filter("l_linenumber = 1").select(F.col("l_orderkey").alias("revision"))
    path = F.concat(F.lit("laws/"), F.col("law").cast("string"), F.lit("/revisions/"), F.col("revision").cast("string"), F.lit(".json"))
    return assembly.with_bodies(_revisions(t).drop("day"), bodies, "revision", path).select("law", "revision", "path")


@query("""select o_custkey as law, o_orderkey as revision, case when o_orderstatus = 'F' then 'history' else 'daily' end as source, case when o_orderkey % 2 = 0 or o_orderstatus <> 'F' then o_orderdate end as day, c_name as title
from orders left join customer on c_custkey = o_custkey and c_custkey % 3 > 0 where o_orderstatus = 'F' or o_orderkey % 2 = 0""")
def law_assembly(t: Tables) -> DataFrame:
    revisions = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("law"), F.col("o_orderkey").alias("revision"))
    dated = _revisions(t).filter("revision % 2 = 0")
    meta = t.customer.filter("c_custkey % 3 > 0").select(F.col("c_custkey").alias("law"), F.col("c_name").alias("title"))
    return assembly.assembled(revisions, dated.union(dated.limit(5)), meta, "law", "revision").select("law", "revision", "source", "day", "title")


@query("select c_custkey as law, c_name as title, n as revisions_count, 'laws/' || c_custkey || '/current.json' as path, '/laws/' || c_custkey as href from customer join (select o_custkey, count(*) as n from orders where o_orderstatus = 'P' group by 1) on o_custkey = c_custkey")
def law_index(t: Tables) -> DataFrame:
    revisions = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("law"))
    laws = assembly.with_revisions(t.customer.select(F.col("c_custkey").alias("law"), F.col("c_name").alias("title")), revisions, "law")
    return assembly.law_index(laws, revisions, "law", "title")


@query("select c_custkey as law, c_name as title, 0::bigint as revisions_count, 'laws/' || c_custkey || '/current.json' as path, '/laws/' || c_custkey as href from customer")
def law_index_rebuilt(t: Tables) -> DataFrame:
    return assembly.law_index(t.customer.select(F.col("c_custkey").alias("law"), F.col("c_name").alias("title")), None, "law", "title")


@query("select o_custkey as law from orders where o_orderstatus = 'P' union select c_custkey from customer where c_custkey % 2 = 0 union select l_suppkey from lineitem")
def law_ids_united(t: Tables) -> DataFrame:
    parts = [t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("law")), t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("law")), t.lineitem.select(F.col("l_suppkey").alias("law"))]
    return assembly.known_ids(parts, "law")


@query("select o_custkey as law, o_orderkey as revision from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def diffs_left_to_build(t: Tables) -> DataFrame:
    done = t.lineitem.filter("l_returnflag = 'R'").join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("law"), F.col("l_orderkey").alias("revision"))
    return assembly.missing_outputs(_revisions(t), done, ["law", "revision"])


@query("select o_orderkey as revision from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 1) order by revision limit 25")
def backfill_next(t: Tables) -> DataFrame:
    return assembly.missing_outputs(t.orders.select(F.col("o_orderkey").alias("revision")), t.lineitem.filter("l_linenumber = 1").select(F.col("l_orderkey").alias("revision")), ["revision"], 25)


@query(f"""with a as {LINES}, o as (select o_custkey as law, max(o_orderkey) as revision, min(o_orderkey) as prev from orders group by 1 having count(*) > 1), n as (select a.* from a join o using (law, revision)), p as (select a.law, a.article, a.body from o join a on a.law = o.law and a.revision = o.prev)
select law, article, 0 as part, case when n.body is null then 'removed' when p.body is null then 'added' when n.body = p.body then 'unchanged' else 'modified' end as change from p left join n using (law, article)
union all select law, article, 1, 'added' from n anti join p using (law, article)""")
def compared_articles(t: Tables) -> DataFrame:
    """The order of the compare page: the first side's articles, then what only the second has."""
    from codexflow.operators.versions import ordered_diff

    pairs = _revisions(t).groupBy("law").agg(F.max("revision").alias("b"), F.min("revision").alias("a")).filter("a <> b")
    held = _articles(t).join(pairs, "law")
    diff = ordered_diff(held.filter("revision = a"), held.filter("revision = b"), ["law", "article"], ["body"], "article", removed_last=False)
    return diff.select("law", "article", "part", "change")


#: Orders with lines are bodies, a third of them under the ids that the metadata has; three laws of four have metadata.
_FILES = """b as (select o_custkey as law, case o_orderkey % 3 when 0 then 'm' else 's' end || o_orderkey as revision, o_orderkey as position, o_orderpriority as title,
list({'no': 'a' || l_linenumber, 'part': l_partkey} order by l_linenumber, l_partkey) as articles from orders join lineitem on l_orderkey = o_orderkey group by all),
m as (select o_custkey as law, 'm' || o_orderkey as revision, o_orderkey as position, case when o_orderstatus = 'P' then 'CurrentEnforced' when o_orderstatus = 'F' then 'Repealed' end as status,
case o_orderkey % 5 when 0 then '1' when 1 then '3' when 2 then '8' when 3 then '9' end as amendment_type, strftime(o_orderdate, '%Y-%m-%d') as effective_date from orders where o_custkey % 4 > 0),
i as (select law, arg_max(revision, position) as body_revision from b group by law),
k as (select law, coalesce(arg_max(revision, position) filter (status = 'CurrentEnforced'), arg_max(revision, position)) as revision from m group by law),
n as (select i.law, body_revision, coalesce(k.revision, body_revision) as cur from i left join k using (law)),
p as (select b.* replace (case when revision = body_revision then cur else revision end as revision), revision = body_revision as last, cur from b join n using (law)),
v as (select m.law, m.revision, m.position, m.status, m.effective_date, null as title, exists (select 1 from p where p.law = m.law and p.revision = m.revision) as body_available from m semi join n using (law)
union all select law, revision, position, null, null, title, true from p where law not in (select law from m)),
e as (select law, 1 as part, position, 'evt_' || revision as event_id, case amendment_type when '1' then 'enactment' when '3' then 'amendment' when '8' then 'repeal' else 'snapshot' end as event_type, coalesce(status, 'Unknown') as status, effective_date, null as promulgation_date from m semi join n using (law)
union all select c_custkey, 0, null, 'evt_' || c_custkey || '_enactment', 'enactment', 'Enacted', null, '2001-01-0' || c_nationkey % 9 + 1 from customer where c_custkey % 3 > 0 and c_custkey in (select law from m semi join n using (law))
union all select law, 1, position, 'evt_' || revision, case when position = min(position) over (partition by law) then 'initial' else 'snapshot' end, 'snapshot', null, null from p where law not in (select law from m))"""


def _law_files(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bodies, metadata and days of enactment."""
    key = F.col("o_orderkey").cast("string")
    article = F.struct("l_linenumber", "l_partkey")
    held = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.array_sort(F.collect_list(article)), lambda a: F.struct(F.concat(F.lit("a"), a["l_linenumber"].cast("string")).alias("no"), a["l_partkey"].alias("part"))).alias("articles"))
    bodies = t.orders.join(held, "o_orderkey").select(F.col("o_custkey").alias("law"), F.concat(F.when(F.col("o_orderkey") % 3 == 0, "m").otherwise("s"), key).alias("revision"), F.col("o_orderkey").alias("position"), F.col("o_orderpriority").alias("title"), "articles")
    kind = F.element_at(F.array(*map(F.lit, "1389"), F.lit(None)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    status = F.when(F.col("o_orderstatus") == "P", "CurrentEnforced").when(F.col("o_orderstatus") == "F", "Repealed")
    meta = t.orders.filter("o_custkey % 4 > 0").select(F.col("o_custkey").alias("law"), F.concat(F.lit("m"), key).alias("revision"), F.col("o_orderkey").alias("position"), status.alias("status"), kind.alias("amendment_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("effective_date"))
    day = F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("2001-01-0"), (F.col("c_nationkey") % 9 + 1).cast("string")))
    return bodies, meta, t.customer.select(F.col("c_custkey").alias("law"), day.alias("date"))


@query(f"with {_FILES} select law, revision, position, status, effective_date, title, case when body_available then 'laws/' || law || '/revisions/' || revision || '.json' end as path, body_available from v")
def law_versions(t: Tables) -> DataFrame:
    bodies, meta, _ = _law_files(t)
    return law_files.versions(meta, bodies, law_files.current_ids(bodies, meta)).drop("amendment_type", "articles")


@query(f"with {_FILES} select law, part, position, event_id, event_type, status, effective_date, promulgation_date from e")
def law_timeline(t: Tables) -> DataFrame:
    bodies, meta, enacted = _law_files(t)
    events = law_files.timeline(meta, bodies, law_files.current_ids(bodies, meta), enacted)
    return events.select("law", "part", "position", "event_id", "event_type", "status", "effective_date", "promulgation_date")


@query(f"""with {_FILES} select law, 'laws/' || law || '/current.json' as path, 0 as part, 0::bigint as position, cur as revision, 'current' as status, title, len(articles) as articles, null as no from p where last
union all select law, 'laws/' || law || '/articles/' || a.no || '.json', 0, 0, null, null, null, null, a.no from (select law, unnest(articles) as a from p where last)
union all select law, 'laws/' || law || '/revisions/' || revision || '.json', 0, 0, revision, case when revision = cur then 'current' else 'historical' end, title, len(articles), null from p
union all select law, 'laws/' || law || '/versions.json', -1, 0, cur, null, null, null, null from n union all select law, 'laws/' || law || '/timeline.json', -1, 0, null, null, null, null, null from n
union all select law, 'laws/' || law || '/versions.json', 1, position, revision, status, title, null, null from v
union all select law, 'laws/' || law || '/timeline.json', part, position, case when part > 0 then event_id[5:] end, status, case when part > 0 and law % 4 = 0 then (select max(title) from p where 'evt_' || p.revision = event_id and p.law = e.law and p.position = e.position) end, null, null from e""")
def law_files_written(t: Tables) -> DataFrame:
    """All files of all laws, written in folders and read back."""
    path = workspace(t.spark, "law-files")
    law_files.write_files(law_files.file_lines(*_law_files(t), "articles", "no"), path)
    said = lambda *names: F.coalesce(*[F.get_json_object("line", f"$.{n}") for n in names])
    count = F.json_array_length(F.get_json_object("line", "$.articles")).cast("long")
    return t.spark.read.parquet(path).select("law", "path", "part", "position", said("revision", "current_revision").alias("revision"), said("status").alias("status"), said("title").alias("title"), count.alias("articles"), said("no").alias("no"))
