"""Files of other forms: zipped XML, legacy encodings, compressed lines, JSON records, directories."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf

from codexflow.functions.text import chamber

MOST_BYTES = 50 << 20


def directory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path``, ``name``, ``length`` and ``content`` of files; hidden ones (``.``, ``_``) are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content")


def _first_xml(content: bytes | None) -> bytes | None:
    if not content or content[:4] != b"PK\x03\x04":
        return content
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for entry in archive.infolist():
            safe = not entry.filename.startswith("/") and ".." not in entry.filename.split("/")
            if safe and entry.filename.lower().endswith(".xml") and entry.file_size <= MOST_BYTES:
                return archive.read(entry)
    return None


@arrow_udf(T.BinaryType())
def unzipped_xml(content: pa.Array) -> pa.Array:
    """The first XML entry of a ZIP file under the size limit; other content stays as it is."""
    return pa.array([_first_xml(x) for x in content.to_pylist()], pa.binary())


@arrow_udf(T.StringType())
def legacy_text(content: pa.Array) -> pa.Array:
    """Text of bytes in the Windows form of Shift JIS; what can't be read becomes the replacement mark."""
    return pa.array([None if x is None else x.decode("cp932", "replace") for x in content.to_pylist()], pa.string())


def _zstd_lines(content: bytes | None) -> list[str] | None:
    if content is None:
        return None
    import zstandard

    text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read().decode()
    return [line for line in text.split("\n") if line.strip()]


@arrow_udf(T.ArrayType(T.StringType()))
def zstd_lines(content: pa.Array) -> pa.Array:
    """Lines of a zstandard file that aren't blank."""
    return pa.array([_zstd_lines(x) for x in content.to_pylist()], pa.list_(pa.string()))


def history_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Revisions in compressed line bundles; ids that begin with a dot are hidden ones."""
    lines = directory(spark, path, "*.zst").select(F.explode(zstd_lines("content")).alias("line"))
    return lines.select(F.from_json("line", schema).alias("r")).select("r.*").filter(~F.startswith(F.coalesce("revision_id", F.lit("")), F.lit(".")))


REVISIONS = (
    "law_info struct<law_id:string,law_num:string,promulgation_date:string>, revisions array<struct<law_revision_id:string,law_title:string,"
    "category:string,amendment_promulgate_date:string,amendment_enforcement_date:string,amendment_scheduled_enforcement_date:string,"
    "amendment_type:string,repeal_status:string,current_revision_status:string,mission:string>>"
)


def revision_rows(text: DataFrame, json_col: str) -> DataFrame:
    """One row a revision of metadata records in JSON; records that can't be read give none."""
    read = text.select(F.from_json(json_col, REVISIONS).alias("r"))
    return read.select("r.law_info.law_id", F.posexplode("r.revisions").alias("place", "v")).select("law_id", "place", "v.*")


def meeting_rows(text: DataFrame, json_col: str) -> DataFrame:
    """Speeches of meeting records: number-or-text fields as integers, speeches without an id left out."""
    speech = "struct<speechID:string,speechOrder:string,speaker:string,speakerGroup:string,speech:string>"
    schema = f"meetingRecord array<struct<issueID:string,meetingId:string,session:string,nameOfHouse:string,nameOfMeeting:string,date:string,speechRecord:array<{speech}>>>"
    read = text.select(F.get(F.from_json(json_col, schema)["meetingRecord"], F.lit(0)).alias("m"))
    rows = read.select(F.coalesce("m.issueID", "m.meetingId").alias("meeting_id"), F.expr("try_cast(m.session as int)").alias("session"), chamber(F.coalesce("m.nameOfHouse", F.lit(""))).alias("house"), F.col("m.date").alias("date"), F.explode("m.speechRecord").alias("s"))
    return rows.filter(F.length(F.coalesce("s.speechID", F.lit(""))) > 0).select(
        "meeting_id", "session", "house", "date", F.col("s.speechID").alias("speech_id"), F.expr("try_cast(s.speechOrder as int)").alias("place"), F.col("s.speaker").alias("speaker"), F.col("s.speech").alias("speech")
    )


def statistic_rows(text: DataFrame, json_col: str) -> DataFrame:
    """Values of a statistics response, long form; empty values are left out."""
    schema = "GET_STATS_DATA struct<STATISTICAL_DATA struct<DATA_INF struct<VALUE array<map<string,string>>>>>"
    values = text.select(F.explode(F.from_json(json_col, schema)["GET_STATS_DATA"]["STATISTICAL_DATA"]["DATA_INF"]["VALUE"]).alias("v"))
    return values.select(*[F.try_element_at("v", F.lit(k)).alias(n) for k, n in (("@area", "area"), ("@time", "time"), ("@cat01", "category"), ("@unit", "unit"), ("$", "value"))]).filter(F.coalesce("value", F.lit("")) != "")


def notice_rows(spark: SparkSession, path: str, row_tags: tuple[str, ...] = ("item", "notice", "procurement")) -> DataFrame:
    """Procurement notices of XML files whose tags have aliases; id and title are required."""
    aliases = {"item_id": ("id", "noticeId", "itemId"), "title": ("title", "name"), "organization": ("organization", "agency"), "publish_date": ("publishDate", "date"), "notice_type": ("noticeType", "type")}
    every = sorted({a for names in aliases.values() for a in names})
    parts = [spark.read.schema(", ".join(f"{a} string" for a in every)).option("rowTag", tag).format("xml").load(path) for tag in row_tags]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    rows = out.select(*[F.coalesce(*[F.nullif(F.trim(F.col(a)), F.lit("")) for a in names]).alias(n) for n, names in aliases.items()])
    return rows.filter("item_id is not null and title is not null").withColumn("notice_type", F.coalesce("notice_type", F.lit("不明")))


def json_number(value: Column) -> Column:
    """Integer that JSON holds as a number or as text."""
    return F.trim(value, F.lit('"')).try_cast("long")
