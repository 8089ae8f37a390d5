"""Sinks: manifests and their check, dated updates, line exports, site maps, caches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexflow.functions.text import escape_markup
from codexflow.sources.files import directory

#: Content types by extension.
CONTENT_TYPES = {"json": "application/json", "ndjson": "application/x-ndjson", "xml": "application/xml", "html": "text/html", "txt": "text/plain", "gz": "application/gzip", "zst": "application/zstd", "db": "application/vnd.sqlite3"}


def content_type(name: Column) -> Column:
    extension = F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))
    out = F.lit("application/octet-stream")
    for key, kind in CONTENT_TYPES.items():
        out = F.when(extension == key, kind).otherwise(out)
    return out


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """``path`` below ``root``, ``sha256``, ``bytes`` and ``content_type`` of every file but the manifest and
    the health record, by path."""
    return manifest_files(spark, root).orderBy("path")


def manifest_files(spark: SparkSession, root: str) -> DataFrame:
    """The rows of ``manifest`` in no order."""
    files = directory(spark, root).filter(~F.col("name").isin("manifest.json", "health.json"))
    relative = F.regexp_replace("path", r"^.*?" + root.rstrip("/").rsplit("/", 1)[-1] + "/", "")
    return files.select(relative.alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), content_type(F.col("name")).alias("content_type"))


def folder_manifest(spark: SparkSession, root: str, pattern: str = ".*") -> DataFrame:
    """``path`` of every folder below ``root`` that holds files, ``sha256`` over the sorted digests of its files, their
    ``bytes`` and number. Names of files don't count, as tasks choose them anew in every run; ``pattern`` is one that
    the path below the root has to match."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    files = manifest_files(spark, root).select(folder.alias("path"), "sha256", "bytes").filter(F.rlike("path", F.lit(pattern)))
    # Digests are 64 characters a file, so a folder's list stays small where its files are large.
    grouped = files.groupBy("path").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ""), 256).alias("sha256"), F.sum("bytes").alias("bytes"), F.count("*").alias("files"))
    return grouped.orderBy("path")


def health(found: DataFrame, faults: DataFrame, dated: DataFrame, date_col: str) -> DataFrame:
    """One row: ``ok`` (no faults), the newest date of what was built (null if nothing was), and the numbers of files,
    their bytes, of entries and of faults."""
    files = found.agg(F.count("*").alias("file_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    entries = dated.agg(F.max(date_col).alias("latest_update_date"), F.count("*").alias("entry_count"))
    bad = faults.agg(F.count("*").alias("fault_count"))
    one = files.crossJoin(entries).crossJoin(bad)  # three single rows
    return one.select((F.col("fault_count") == 0).alias("ok"), "latest_update_date", "entry_count", "file_count", "bytes", "fault_count")


def mismatches(stated: DataFrame, found: DataFrame) -> DataFrame:
    """Files that are missing, unlisted, or differ in digest or size."""
    joined = stated.alias("a").join(found.alias("b"), "path", "full_outer")
    fault = F.when(F.col("b.sha256").isNull(), "missing").when(F.col("a.sha256").isNull(), "unlisted").when((F.col("a.sha256") != F.col("b.sha256")) | (F.col("a.bytes") != F.col("b.bytes")), "changed")
    return joined.select("path", fault.alias("fault")).filter("fault is not null")


def write_by_date(rows: DataFrame, date_col: str, path: str) -> None:
    """A folder a date; a date with very many rows is written by several tasks."""
    rows.hint("rebalance", date_col).write.mode("overwrite").partitionBy(date_col).json(path)


def write_lines(rows: DataFrame, path: str, compression: str = "gzip") -> None:
    rows.write.mode("overwrite").option("compression", compression).json(path)


def site_map(urls: DataFrame, url_col: str) -> DataFrame:
    """One line a page, for a text sink; head and foot are the writer's."""
    return urls.select(F.concat(F.lit("<url><loc>"), escape_markup(F.col(url_col)), F.lit("</loc></url>")).alias("value"))


def compression_stats(spark: SparkSession, root: str) -> DataFrame:
    """Number and bytes of the files that are compressed ahead: JSON and lines, not indices."""
    files = directory(spark, root).filter(F.col("name").rlike(r"\.(json|ndjson)$") & ~F.startswith("name", F.lit("search.db")))
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
