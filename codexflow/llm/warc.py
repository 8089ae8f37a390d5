"""WARC archives: written as text records by Spark, read back by boundary-chain verification.

Writing: every page becomes one record. Of the pages with equal payloads that with the largest id is
a ``response``; the others are ``revisit`` records that name it and carry no payload. Record text
ends with the blank lines that the format asks for, so Spark's text sink writes whole archives.
They stay uncompressed, so one archive is read by many tasks.

Reading: archives are split like any text, at the magic that begins a record. A payload may hold that
magic too, so a place where it stands is only a candidate. The task that reads a split parses every
candidate's header and emits its offset and its successor's (the end that its length fields give).
Pointers first jump inside the split, to the first offset behind it; then the files' frontiers jump
from split to split, starting at offset 0. What no chain from the start of a file reaches was magic
inside a payload. The payload of a record with such magic inside lies in several segments; where there
are such records, a second pass over the archives fetches the segments that they cover. Archives of
other writers are read too: any record type and id, versions 1.0 and 1.1, and compressed ones (whole or
one member a record), each of which is one split.

Defined results: a null payload is empty; pages of equal payload and equal largest id are all
responses; a page without an id is a revisit of the largest id if there is one, else a response; ids of
any type are written as text and come back in their type; empty tables give no records; other columns
of the input aren't written.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from codexflow.llm.common import shared_dir, stored, text_bytes

#: What stands before the second digit of the version at the begin of every record.
MAGIC, VERSIONS = "WARC/1.", (b"0\r\n", b"1\r\n")
END = "\r\n\r\n"
#: Bytes of a split of an uncompressed archive.
SPLIT_BYTES = 16 << 20
#: Offsets are compared inside blocks of so many bytes when cut records are put together.
SPAN = 1 << 20


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the payload's SHA-1: five hexadecimal digits at a time become four letters."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", min_revisit_bytes: int = 0, compression: str = "none") -> None:
    """Write one record a row below ``path``, dated now. Payloads under ``min_revisit_bytes`` are always responses.

    An uncompressed archive is read by one task for each split, a compressed one (``gzip``) by one task.
    """
    url = F.coalesce(F.regexp_replace(F.col(url_col).cast("string"), r"[\x00-\x20\x7F]", "%20"), F.lit("")) if url_col else F.lit("")
    page = pages.select(F.col(id_col).alias("id"), url.alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    page = page.withColumn("size", F.octet_length("payload")).withColumn("digest", sha1_base32(F.col("payload").cast("binary")))
    many = page.filter(F.col("size") >= min_revisit_bytes).groupBy("digest", "size").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    many = stored(many.select("digest", "size", "first"), "repeated")  # so that the pages of a hot payload can be split
    page = page.join(many, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = lambda col: F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(F.col(col).cast("string")), F.lit("")), F.lit(">"))
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("id")),
        F.concat(F.lit("WARC-Date: "), now),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name("first"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("body").cast("string")),
    ]
    record = page.withColumn("body", body).select(F.concat(F.lit(MAGIC + "0\r\n"), F.concat_ws("\r\n", *lines), F.lit(END), F.col("body")).alias("value"))
    record.write.option("lineSep", END).option("compression", compression).text(path)


_CANDIDATE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("at", T.LongType()),  # from the first line that begins in the block
        T.StructField("size", T.LongType()),  # of the segment up to the next magic, or of the whole block
        T.StructField("next", T.LongType()),  # the successor, counted like at; null: no record can begin here
        T.StructField("out", T.LongType()),  # the first offset of its chain that isn't inside the block
        T.StructField("total", T.BooleanType()),
        T.StructField("head", T.LongType()),  # bytes before the payload
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("refers", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("stated", T.StringType()),
        T.StructField("stated_bytes", T.LongType()),
        T.StructField("digest", T.StringType()),  # null: the record goes on behind the next magic
    ]
)

_FIELD = re.compile(rb"([!-9;-~]+):[ \t]*([^\r\n]*)\r\n")


def parse_record(segment: bytes) -> dict | None:
    """Fields of the record whose text follows the magic, or None if its header can't be one."""
    stop = segment.find(b"\r\n\r\n")
    if stop < 0 or not segment.startswith(VERSIONS):
        return None
    fields, at = {}, len(VERSIONS[0])
    while at < stop + 2:
        found = _FIELD.match(segment, at)
        if not found:
            return None
        fields[found[1].lower()] = found[2]
        at = found.end()
    kind, length, name = fields.get(b"warc-type", b""), fields.get(b"content-length", b""), fields.get(b"warc-record-id", b"")
    if not kind or not length.isdigit() or not (name.startswith(b"<") and name.endswith(b">")):
        return None
    head, size = stop + 4, None
    if fields.get(b"content-type", b"").replace(b" ", b"").startswith(b"application/http"):
        head = segment.find(b"\r\n\r\n", stop + 4) + 4
        if head < 4 or head - stop - 4 > int(length):
            head = stop + 4 + int(length)  # headers alone
        size = re.search(rb"\r\n[Cc]ontent-[Ll]ength:[ \t]*(\d+)\r\n", segment[stop + 4 : head])
    text = lambda key: fields[key].decode("utf-8", "replace").strip("<>") if key in fields else None
    return {
        "end": stop + 4 + int(length) + len(END),
        "head": head,
        "name": text(b"warc-record-id"),
        "type": kind.decode("utf-8", "replace"),
        "refers": text(b"warc-refers-to"),
        "uri": text(b"warc-target-uri"),
        "stated": fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("utf-8", "replace"),
        "stated_bytes": int(size[1]) if size else None,
    }


def _placed(batches):
    """File, block, place and bytes of every segment. A block's segments come one after another; their
    places count from the first one that begins in the block. What stands before a file's first magic
    is left out."""
    key, at = None, 0
    for batch in batches:
        for file, block, value in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), text_bytes(batch.column("value"))):
            if (file, block) != key:
                key, at = (file, block), 0
            start = at - len(MAGIC)
            at += len(value) + len(MAGIC)
            yield file, block, start, value


def _candidates(batches):
    """Candidates of the blocks in a task, and one row for each block's size."""
    magic = len(MAGIC)
    key, held, size = None, [], 0

    def ended():
        """Chains inside the block by pointer jumping; then the rows of the block."""
        place = {row["at"]: i for i, row in enumerate(held) if row["next"] is not None}
        out = np.array([row["next"] if row["next"] is not None else row["at"] for row in held], np.int64)
        jump = np.array([place.get(x, -1) for x in out.tolist()], np.int64)
        while (live := np.flatnonzero(jump >= 0)).size:
            out[live], jump[live] = out[jump[live]], jump[jump[live]]
        for row, x in zip(held, out.tolist()):
            row["out"] = x if row["next"] is not None else None
        held.append({"file": key[0], "block": key[1], "size": size, "total": True})
        return pa.RecordBatch.from_pylist(held, schema=_ARROW)

    for file, block, start, value in _placed(batches):
        if (file, block) != key:
            if key is not None:
                yield ended()
            key, held = (file, block), []
        size = start + 2 * magic + len(value)
        found = parse_record(value) if block or start >= 0 else None
        if found is None:
            continue
        row = {"file": file, "block": block, "at": start, "size": len(value) + magic, "total": False}
        row |= {k: found[k] for k in ("name", "type", "refers", "uri", "stated", "stated_bytes")}
        row |= {"next": start + magic + found["end"], "head": magic + found["head"]}
        if found["end"] <= len(value):
            payload = value[found["head"] : found["end"] - len(END)]
            row["digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        held.append(row)
    if key is not None:
        yield ended()


def _segments(batches):
    """Place and bytes of every segment, in batches of about ``SPAN`` bytes."""
    rows, size = [], 0
    for row in _placed(batches):
        rows.append(row)
        size += len(row[3])
        if size >= SPAN:
            yield _segment_batch(rows)
            rows, size = [], 0
    if rows:
        yield _segment_batch(rows)


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in columns], names=["file", "block", "from", "raw"])


_ARROW = pa.schema(
    [
        (f.name, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[f.dataType.simpleString()])
        for f in _CANDIDATE
    ]
)


def read_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the archives below ``path``: ``id`` (text; null for other writers' records), ``type``,
    ``refers_to`` (like ``id``), ``payload_bytes`` and ``payload_digest`` of the full payload, ``verified``
    (the bytes read match the stated digest; of a revisit, those of the response that it names),
    ``record_id`` and ``uri``. Uncompressed archives are split at ``split_bytes``."""
    # Split sizes are a session's setting: the passes over the archives plan in a session of their own.
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    lines = reader.read.option("lineSep", MAGIC).text(path)
    lines = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    found = stored(lines.mapInArrow(_candidates, _CANDIDATE), "warc-candidates", spark)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = found.filter("total").select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    placed = found.filter("not total").join(blocks, ["file", "block"])
    placed = placed.withColumns({k: F.col(k) + F.col("base") for k in ("at", "next", "out")}).drop("base", "total", "size")
    chain = stored(placed.drop("out").join(_entries(placed), ["file", "block"]).groupBy("file", "block").applyInArrow(_on_chain, placed.drop("out").schema), "warc-chain")
    whole = chain.filter(F.col("digest").isNotNull())
    cut = chain.filter(F.col("digest").isNull()).drop("digest")
    if not cut.isEmpty():
        segments = lines.mapInArrow(_segments, "file string, block long, from long, raw binary")
        whole = whole.unionByName(stored(_put_together(segments, stored(blocks, "warc-blocks"), cut), "warc-cut", spark))
    return _records(whole)


def _entries(placed: DataFrame) -> DataFrame:
    """Where the chain from a file's start enters each block that it enters.

    Pointers double in every round: what is reached also reaches what its pointer, now over twice as
    many blocks, leads to.
    """
    links = placed.filter("next is not null").select("file", "block", "at", "out")
    enter = links.select("file", F.col("out").alias("at")).distinct()
    hops = stored(links.join(enter, ["file", "at"], "left_semi").unionByName(links.filter(F.col("at") == 0)).distinct(), "warc-hops")
    jump, reach, size = hops.select("file", "at", "out"), hops.filter(F.col("at") == 0).select("file", "at"), -1
    while True:
        ahead = reach.join(jump, ["file", "at"]).select("file", F.col("out").alias("at"))
        reach = stored(reach.union(ahead).distinct(), "warc-reach")
        if size == (now := reach.count()):
            return hops.join(reach, ["file", "at"]).select("file", "block", F.col("at").alias("entry"))
        size = now
        jump = stored(jump.join(jump.select("file", F.col("at").alias("out"), F.col("out").alias("beyond")), ["file", "out"]).select("file", "at", F.col("beyond").alias("out")), "warc-jump")


def _on_chain(table: pa.Table) -> pa.Table:
    """Of the candidates of one block, those on the chain from its entry."""
    at, ahead = table.column("at").to_pylist(), table.column("next").to_pylist()
    place = dict(zip(at, range(len(at))))
    now, kept = place.get(table.column("entry")[0].as_py()), []
    while now is not None:
        kept.append(now)
        now = place.get(ahead[now])
    return table.take(pa.array(sorted(kept), pa.int64())).drop_columns(["entry"])


def _put_together(segments: DataFrame, blocks: DataFrame, cut: DataFrame) -> DataFrame:
    """``cut`` with the digests of payloads that lie in several segments."""
    wide = stored(cut.select("file", "at", "next", F.explode(F.expr(f"sequence(at div {SPAN}, next div {SPAN})")).alias("span")), "warc-spans")
    parts = segments.join(blocks, ["file", "block"]).select("file", (F.col("from") + F.col("base")).alias("from"), "raw")
    met = parts.withColumn("span", F.expr(f"from div {SPAN}")).join(wide, ["file", "span"]).filter("from >= at and from < next")
    joined = met.groupBy("file", "at").agg(F.array_sort(F.collect_list(F.struct("from", F.col("raw").cast("string").alias("text")))).alias("parts"))
    text = F.concat(F.lit(MAGIC), F.array_join(F.transform("parts", lambda x: x["text"]), MAGIC)).cast("binary")
    size = F.col("next") - F.col("at") - F.col("head") - F.lit(len(END))
    payload = F.substring(text, (F.col("head") + 1).cast("int"), size.cast("int"))
    return cut.join(joined, ["file", "at"]).withColumn("digest", sha1_base32(payload)).drop("parts")


def _records(chain: DataFrame) -> DataFrame:
    revisit = F.col("type") == "revisit"
    own = lambda col: F.url_decode(F.regexp_extract(col, "^urn:page:(.+)$", 1))
    known = chain.filter((F.col("type") == "response") & (F.col("digest") == F.col("stated"))).groupBy(F.col("name").alias("refers"), "stated").agg(F.lit(True).alias("held"))
    return chain.join(known, ["refers", "stated"], "left").select(
        F.when(F.col("name").rlike("^urn:page:."), own("name")).alias("id"),
        "type",
        F.when(F.col("refers").rlike("^urn:page:."), own("refers")).alias("refers_to"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("next") - F.col("at") - F.col("head") - F.lit(len(END))).alias("payload_bytes"),
        F.when(revisit, F.col("stated")).otherwise(F.col("digest")).alias("payload_digest"),
        F.when(revisit, F.coalesce("held", F.lit(False))).otherwise(F.col("digest") == F.col("stated")).alias("verified"),
        F.col("name").alias("record_id"),
        "uri",
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Write the pages' archives into shared storage and read their records back, ids in their own type."""
    path = shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, **options)
    kind = pages.schema[id_col].dataType
    return read_archives(pages.sparkSession, path).withColumns({k: F.col(k).cast(kind) for k in ("id", "refers_to")})
