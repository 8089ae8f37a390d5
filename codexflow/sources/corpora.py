"""Tables made of the pages of public corpora: gazette contents, bills, comments, circulars, ordinances, layouts."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.window import Window

from codexflow.functions import gazette
from codexflow.functions.text import plain_number
from codexflow.sources.markup import case_id, label_values, labels_of, page_pairs


def gazette_items(nodes: DataFrame) -> DataFrame:
    """Items of a contents page (``id`` is its compact date) under the issue heading before them; an
    item that repeats in an issue counts once."""
    by = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    link = nodes.filter(F.col("tag") == "a").withColumn("kind", gazette.issue_kind(F.col("text")))
    heading = F.when(F.col("kind").isNotNull(), F.struct("kind", gazette.issue_number(F.col("text")).alias("number"), F.col("place").alias("at")))
    held = link.withColumn("issue", F.last(heading, True).over(by)).filter(F.col("kind").isNull() & F.col("issue").isNotNull())
    page = F.regexp_extract("href", r"^([^/]+)/\1(\d+)f\.html$", 2).try_cast("int")
    items = held.select("id", "issue", "place", gazette.item_title(F.col("text")).alias("title"), page.alias("page"), "href").filter("page is not null and title <> '' and startswith(href, id)")
    first = items.groupBy("id", "issue", "title", "page").agg(F.min_by("href", "place").alias("href"), F.min("place").alias("place"))
    return first.select("id", "issue.kind", "issue.number", "title", "page", "href", "place", gazette.agency(F.col("title")).alias("agency"))


def bills(nodes: DataFrame) -> DataFrame:
    """``bill_id``, ``title``, ``status`` of table rows with a progress link; the first row of an id wins."""
    by = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = nodes.withColumn("row", F.last(F.when(F.col("tag") == "tr", F.col("place")), True).over(by)).filter("row is not null")
    cell = F.when((F.col("tag") == "td") & ~F.col("text").isin("", "経過", "本文"), F.struct("place", "text"))
    link = F.when((F.col("tag") == "a") & F.contains("href", F.lit("keika/")), F.struct("place", F.regexp_extract("href", r"([^/]+?)(?:\.htm)?$", 1).alias("bill_id")))
    grouped = row.groupBy("id", "row").agg(F.min(link).alias("link"), F.array_sort(F.collect_list(cell)).alias("cells")).filter("link is not null and size(cells) > 0")
    named = grouped.select("id", "row", "link.bill_id", F.get("cells", F.lit(0))["text"].alias("title"), F.get("cells", F.lit(1))["text"].alias("status")).filter("bill_id <> ''")
    return named.groupBy("id", "bill_id").agg(F.min_by("title", "row").alias("title"), F.min_by("status", "row").alias("status"))


#: Labels of a comment case's table and the fields they fill.
CASE_LABELS = {"案件番号": "case_id", "定めようとする命令などの題名": "command_title", "根拠法令条項": "legal_basis", "所管省庁・部局名等": "responsible_office", "受付開始日時": "reception_start", "受付締切日時": "reception_end"}


def comment_cases(nodes: DataFrame) -> DataFrame:
    """One row a case page: its labelled fields, null where a label is missing."""
    values = label_values(nodes)
    return values.groupBy("id").agg(*[F.max(F.when(F.startswith("label", F.lit(label)), F.col("value"))).alias(name) for label, name in CASE_LABELS.items()])


def comment_pages(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """What ``comment_cases`` gives, of pages whose ids differ, without a shuffle."""
    held = page_pairs(pages, id_col, html_col, labels_of)
    value = lambda label: F.array_max(F.transform(F.filter("pairs", lambda p: F.startswith(p["label"], F.lit(label))), lambda p: p["value"]))
    return held.select("id", *[value(label).alias(name) for label, name in CASE_LABELS.items()])


def comment_list(nodes: DataFrame) -> DataFrame:
    """``case_id`` and ``title`` of the cards of a list page; the id comes from the link or its handler."""
    links = nodes.filter(F.col("tag") == "a").withColumn("case_id", F.coalesce(case_id(F.col("onclick")), case_id(F.col("href")))).filter("case_id is not null")
    return links.groupBy("id", "case_id").agg(F.min_by("text", "place").alias("title"))


def circular_items(nodes: DataFrame) -> DataFrame:
    """``number``, ``caption`` and ``text`` of a circular's paragraphs that begin with a number."""
    by = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = nodes.filter(F.col("tag").isin("h2", "p")).withColumn("caption", F.last(F.when(F.col("tag") == "h2", F.col("text")), True).over(by))
    lead = F.regexp_extract("text", r"(?U)^([0-9０-９−－\-ー\s]+)", 1)
    items = seen.filter((F.col("tag") == "p") & F.coalesce(F.col("classes") == "indent1", F.lit(False)) & gazette.is_number_like(lead))
    return items.select("id", "place", "caption", plain_number(lead).alias("number"), F.regexp_replace("text", r"(?U)^[0-9０-９−－\-ー\s]+", "").alias("text"))


def ordinance_articles(nodes: DataFrame) -> DataFrame:
    """``article_no``, ``caption`` and ``text`` of the article blocks of an ordinance."""
    blocks = nodes.filter((F.col("tag") == "div") & F.coalesce(F.col("classes") == "article", F.lit(False)))
    number = F.nullif(F.regexp_extract("text", "(第[0-9０-９一二三四五六七八九十百千]+条(?:の[0-9０-９一二三四五六七八九十]+)*)", 1), F.lit(""))
    return blocks.select("id", "place", number.alias("article_no"), F.nullif(F.regexp_extract("text", "^（([^）]+)）", 1), F.lit("")).alias("caption"), "text")


def _words(xhtml: str | None) -> list[dict]:
    out, page, height = [], 0, 0.0
    for tag, attributes, text in re.findall(r"<(page|word)\b([^>]*)>([^<]*)", xhtml or ""):
        values = {k.lower(): float(v) for k, v in re.findall(r'(\w+)="([\d.]+)"', attributes)}
        if tag == "page":
            page, height = page + 1, values.get("height", 0.0)
        elif {"xmin", "ymin", "xmax", "ymax"} <= values.keys() and text.strip():
            if values["ymin"] >= 56 and values["ymin"] <= height - 30:  # inside the margins
                out.append({"page": page, "x": (values["xmin"] + values["xmax"]) / 2, "y": values["ymin"], "y1": values["ymax"], "text": text.strip()})
    return out


_WORD = T.StructType([T.StructField("page", T.IntegerType()), *[T.StructField(k, T.DoubleType()) for k in ("x", "y", "y1")], T.StructField("text", T.StringType())])


@arrow_udf(T.ArrayType(_WORD))
def layout_words(xhtml: pa.Array) -> pa.Array:
    """Words with coordinates from extracted page layouts."""
    kind = pa.list_(pa.struct([("page", pa.int32()), ("x", pa.float64()), ("y", pa.float64()), ("y1", pa.float64()), ("text", pa.string())]))
    return pa.array([_words(x) for x in xhtml.to_pylist()], kind)


def _compose(a: tuple, b: tuple) -> tuple:
    """The affine map that applies ``b`` first, then ``a``."""
    return (a[0] * b[0] + a[2] * b[1], a[1] * b[0] + a[3] * b[1], a[0] * b[2] + a[2] * b[3], a[1] * b[2] + a[3] * b[3], a[0] * b[4] + a[2] * b[5] + a[4], a[1] * b[4] + a[3] * b[5] + a[5])


def _rules(svg: str | None) -> list[dict]:
    out, stack = [], [(1.0, 0.0, 0.0, 1.0, 0.0, 0.0)]
    for closing, tag, attributes, empty in re.findall(r"<(/?)(g|path)\b([^>]*?)(/?)>", svg or ""):
        if closing:
            if tag == "g" and len(stack) > 1:
                stack.pop()
            continue
        found = re.search(r'transform="matrix\(([^)]*)\)"', attributes)
        own = tuple(map(float, re.split(r"[ ,]+", found[1].strip()))) if found else (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
        now = _compose(stack[-1], own)
        if tag == "g":
            if not empty:
                stack.append(now)
            continue
        straight = re.search(r'\bd="\s*M\s*([-\d.]+)[ ,]+([-\d.]+)\s*L\s*([-\d.]+)[ ,]+([-\d.]+)\s*"', attributes)
        if straight:
            x0, y0, x1, y1 = map(float, straight.groups())
            (a, b), (c, d) = ((now[0] * x + now[2] * y + now[4], now[1] * x + now[3] * y + now[5]) for x, y in ((x0, y0), (x1, y1)))
            if abs(a - c) < 2 and abs(b - d) > 15:
                out.append({"kind": "v", "pos": (a + c) / 2, "lo": min(b, d), "hi": max(b, d)})
            elif abs(b - d) < 2 and abs(a - c) > 15:
                out.append({"kind": "h", "pos": (b + d) / 2, "lo": min(a, c), "hi": max(a, c)})
    return out


_RULE = T.StructType([T.StructField("kind", T.StringType()), *[T.StructField(k, T.DoubleType()) for k in ("pos", "lo", "hi")]])


@arrow_udf(T.ArrayType(_RULE))
def layout_rules(svg: pa.Array) -> pa.Array:
    """Straight rules of drawn pages, under the transformations around them."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("pos", pa.float64()), ("lo", pa.float64()), ("hi", pa.float64())]))
    return pa.array([_rules(x) for x in svg.to_pylist()], kind)
