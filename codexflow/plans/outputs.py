"""What a build publishes, written into shared storage and read back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexflow.plans.base import Tables, query
from codexflow.sources import outputs, sinks
from codexflow.sources.workspace import workspace


@query("select c_custkey, c_name, c_mktsegment from customer")
def documents_written(t: Tables) -> DataFrame:
    rows, path = t.customer.select("c_custkey", "c_name", "c_mktsegment"), workspace(t.spark, "documents")
    outputs.write_documents(rows, "c_custkey", path)
    return t.spark.read.schema(rows.schema).json(path).drop("bucket")


@query("select c_custkey, c_name from customer where c_custkey = 42")
def document_of_one_law(t: Tables) -> DataFrame:
    rows, path = t.customer.select("c_custkey", "c_name"), workspace(t.spark, "documents")
    outputs.write_documents(rows, "c_custkey", path)
    return outputs.read_document(t.spark, path, rows.schema, "c_custkey", F.lit(42).cast("long"))


@query("select o_custkey, o_orderkey, o_totalprice from orders")
def history_archived(t: Tables) -> DataFrame:
    path = workspace(t.spark, "history")
    outputs.write_archive(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), path, ["o_custkey", "o_orderkey"])
    return t.spark.read.parquet(path)


@query("""select 0 as part, '{"name":"laws","count":' || count(*) || ',"generated_at":"2026"}' as line from customer union all select 1, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' from customer""")
def index_lines(t: Tables) -> DataFrame:
    return outputs.index_document(t.customer.select("c_custkey", "c_name"), "laws", [F.col("c_custkey")], F.lit("2026"))


@query("select o_orderkey from orders where o_orderdate = (select max(o_orderdate) from orders)")
def latest_document(t: Tables) -> DataFrame:
    return outputs.latest_document(t.orders, "o_orderdate").select("o_orderkey")


@query("select o_orderkey, case o_orderkey % 4 when 0 then 'unreadable' when 1 then 'b' end as fault from orders where o_orderkey % 4 < 2")
def schema_faults(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    line = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit('{"a":"x'), key)).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit('{"a":'), key, F.lit("}"))).otherwise(F.concat(F.lit('{"b":"y","a":'), key, F.lit("}")))
    schema = T.StructType.fromJson(json.loads(outputs.schema_text(t.orders.select(F.col("o_orderkey").alias("a"), F.lit("").alias("b")))))
    return outputs.faults(t.orders.select("o_orderkey", line.alias("line")), "line", T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]), ["a", "b"]).select("o_orderkey", "fault")


@query("select c_custkey, c_name as name, c_nationkey as nation from customer")
def metadata_packed(t: Tables) -> DataFrame:
    rows, path = t.customer.select("c_name", "c_custkey", "c_nationkey"), workspace(t.spark, "packed")
    outputs.packed(rows, "c_custkey").write.text(path)
    found = outputs.unpacked(t.spark.read.text(path), rows.schema, "c_custkey")
    return found.select("c_custkey", F.col("meta.c_name").alias("name"), F.col("meta.c_nationkey").alias("nation"))


@query("select s_suppkey, 2 as version from supplier")
def folder_swapped(t: Tables) -> DataFrame:
    root = workspace(t.spark, "swap")
    for version in (1, 2):
        t.supplier.select("s_suppkey", F.lit(version).alias("version")).write.parquet(f"{root}/built")
        outputs.swap_into(t.spark, f"{root}/built", f"{root}/published")
    return t.spark.read.parquet(f"{root}/published")


_STATE = "(select o_custkey as source, count(*) as items, count(*) filter (o_orderstatus = 'F') as failures, max(strftime(o_orderdate, '%Y-%m-%d')) filter (o_orderstatus <> 'F') as last_success from orders group by 1)"


@query(f"select source, items, failures, last_success, case when failures = 0 then 'ok' when failures < items then 'partial' else 'failed' end as status from {_STATE}")
def run_states(t: Tables) -> DataFrame:
    return _run(t)


@query(f"""select c_custkey as source, coalesce(last_success, '1990-01-01') as last_success from customer left join {_STATE} s on source = c_custkey""")
def run_states_merged(t: Tables) -> DataFrame:
    before = t.customer.select(F.col("c_custkey").alias("source"), F.lit("1990-01-01").alias("last_success"), F.lit(0).cast("long").alias("items"), F.lit(0).cast("long").alias("failures"), F.lit("ok").alias("status"))
    return outputs.merged_state(before, _run(t), "source").select("source", "last_success")


def _run(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("source"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return outputs.run_state(rows, "source", F.col("o_orderstatus") == "F", "day")


@query("select 'customer' as name, count(*) as n from customer union all select 'missing', 0")
def views_of_endpoints(t: Tables) -> DataFrame:
    outputs.catalog(t.spark, t.sf_dir, {"customer": "c_custkey long", "missing": "a string"}, "endpoint_")
    return t.spark.sql("select 'customer' as name, count(*) as n from endpoint_customer union all select 'missing', count(*) from endpoint_missing")


@query("select strftime(o_orderdate, '%Y-%m-%d') as day, count(*) as n from orders group by 1")
def updates_written_by_date(t: Tables) -> DataFrame:
    path = workspace(t.spark, "updates")
    sinks.write_by_date(t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "month", path)
    return t.spark.read.schema("o_orderkey long, day string, month string").json(path).groupBy("day").agg(F.count("*").alias("n"))


@query("select 'https://a.example/?a=1&amp;b=' || c_custkey as loc from customer")
def site_map_lines(t: Tables) -> DataFrame:
    urls = t.customer.select(F.concat(F.lit("https://a.example/?a=1&b="), F.col("c_custkey").cast("string")).alias("url"))
    return sinks.site_map(urls, "url").select(F.regexp_extract("value", "<url><loc>(.*)</loc></url>", 1).alias("loc"))


_LINES = "(select 'nation=' || c_nationkey as path, string_agg(c_custkey || '|' || {name} || chr(10), '' order by c_custkey) as body from customer {where} group by 1)"


def _written(t: Tables, rows: DataFrame) -> str:
    """A folder a nation, of lines in the order of keys."""
    path = workspace(t.spark, "site")
    line = F.concat(F.col("c_custkey").cast("string"), F.lit("|"), "c_name").alias("value")
    rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select(line, F.col("c_nationkey").alias("nation")).write.partitionBy("nation").text(path)
    return path


def _changed(t: Tables) -> DataFrame:
    """Without the nations of every fourth place, with other names of those after them, and one more nation."""
    renamed = F.when(F.col("c_nationkey") % 4 == 1, F.upper("c_name")).otherwise(F.col("c_name"))
    kept = t.customer.filter("c_nationkey % 4 > 0").withColumn("c_name", renamed)
    return kept.unionByName(t.customer.filter("c_nationkey = 3").withColumn("c_nationkey", F.lit(99)))


@query(f"select path, sha256(sha256(body)) as sha256, octet_length(encode(body))::bigint as bytes, 1::bigint as files from {_LINES.format(name='c_name', where='')}")
def manifest_of_folders(t: Tables) -> DataFrame:
    """The manifest of folders that were written from a table."""
    return sinks.folder_manifest(t.spark, _written(t, t.customer), "^nation=")


@query("""select distinct 'nation=' || c_nationkey as path, case c_nationkey % 4 when 0 then 'missing' else 'changed' end as fault from customer where c_nationkey % 4 < 2
union all select distinct 'nation=99', 'unlisted' from customer where c_nationkey = 3""")
def manifest_checked(t: Tables) -> DataFrame:
    """What differs between a manifest and the folders of a later build."""
    return sinks.mismatches(*_two_manifests(t))


def _two_manifests(t: Tables) -> tuple[DataFrame, DataFrame]:
    return sinks.folder_manifest(t.spark, _written(t, t.customer), "^nation="), sinks.folder_manifest(t.spark, _written(t, _changed(t)), "^nation=")


@query(f"""with f as (select * from {_LINES.format(name="case when c_nationkey % 4 = 1 then upper(c_name) else c_name end", where="where c_nationkey % 4 > 0")}
union all select 'nation=99', body from {_LINES.format(name="c_name", where="where c_nationkey = 3")})
select false as ok, (select strftime(max(o_orderdate), '%Y-%m-%d') from orders) as latest_update_date, (select count(*) from orders) as entry_count, (select count(*) from f) as file_count,
(select sum(octet_length(encode(body)))::bigint from f) as bytes, (select count(distinct c_nationkey) from customer where c_nationkey % 4 < 2) + (select count(distinct c_nationkey) from customer where c_nationkey = 3) as fault_count""")
def health_record(t: Tables) -> DataFrame:
    stated, found = _two_manifests(t)
    return sinks.health(found, sinks.mismatches(stated, found), t.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "day")
