"""HTML as rows: a table function over the standard parser, and columns made from its rows."""

from __future__ import annotations

import re
from collections.abc import Collection
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codexflow.operators.batches import slices

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "noscript", "template"}
NAMED = {"id", "class", "href", "onclick", "headers"}
#: A plain page: lower-case tags with quoted attributes, without references, comments, hidden elements or such that hold no markup.
PLAIN = re.compile(
    r"""(?:[^<&]++|<(?:/[a-z][a-z0-9]*+|(?!script|style|noscript|template|title|textarea|iframe|noembed|noframes|xmp|plaintext)[a-z][a-z0-9]*+(?: [a-z-]++=(?:'[^'<>&]*+'|"[^"<>&]*+"))*+)>)*+"""
)
#: A cell of a plain page that holds text alone.
CELL = re.compile(r"""<(t[hd])(?: headers=(?:'(\w+)'|"(\w+)"))?>([^<&]*)</\1>""")
#: Of a plain page a closing tag, an opening tag with its attributes, and text.
TOKEN = re.compile(r"</([a-z0-9]+)>|<([a-z0-9]+) ?([^>]*)>|([^<]+)")
ATTRIBUTE = re.compile(r"""([a-z-]+)=(?:'([^']*)'|"([^"]*)")""")
#: Characters of pages whose elements make up one batch.
BATCH_CHARACTERS = 2 << 20


class _Nodes(HTMLParser):
    """Elements in document order, each with its own text and the text of what it holds."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[dict] = []

    def handle_starttag(self, tag, attrs):
        values = {k: v or "" for k, v in attrs}
        row = {"tag": tag, "parent": self.open[-1]["place"] if self.open else None, "place": len(self.rows), "id": values.get("id"), "class": values.get("class"), "href": values.get("href"), "text": []}
        row |= {"onclick": values.get("onclick"), "headers": values.get("headers"), "upto": row["place"] if tag in VOID else None}
        self.rows.append(row)
        if tag not in VOID:
            self.open.append(row)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth]["tag"] == tag:
                for row in self.open[depth:]:
                    row["upto"] = len(self.rows) - 1
                del self.open[depth:]
                return

    def handle_data(self, data):
        if not any(row["tag"] in HIDDEN for row in self.open):
            for row in self.open:
                row["text"].append(data)


def parse_nodes(html: str, tags: Collection[str] | None = None) -> list[dict]:
    """Elements in document order, or those of ``tags``."""
    if PLAIN.fullmatch(html):
        return _plain_nodes(html, tags)
    parser = _Nodes()
    parser.feed(html)
    parser.close()
    last = len(parser.rows) - 1
    return [row | {"text": " ".join("".join(row["text"]).split()), "upto": last if row["upto"] is None else row["upto"]} for row in parser.rows if tags is None or row["tag"] in tags]


def parse_cells(html: str) -> list[dict]:
    """``tag``, ``headers`` and ``text`` of the ``th`` and ``td`` of a page, in document order."""
    if PLAIN.fullmatch(html):
        cells = CELL.findall(html)
        if len(cells) == html.count("<td") + html.count("<th"):
            return [{"tag": tag, "headers": single or double or None, "text": " ".join(text.split())} for tag, single, double, text in cells]
    return parse_nodes(html, ("th", "td"))


def _plain_nodes(html: str, tags: Collection[str] | None) -> list[dict]:
    """What the parser gives for a plain page, by one pass of a pattern."""
    rows: list[dict] = []
    texts: list[str] = []
    holding: list[dict] = []
    open_tags: list[str] = []
    place = -1
    for closed, tag, attributes, text in TOKEN.findall(html):
        if text:
            texts.append(text)
        elif tag:
            place += 1
            row = {"tag": tag, "parent": holding[-1]["place"] if holding else None, "place": place, "id": None, "class": None, "href": None, "onclick": None, "headers": None, "upto": place, "text": ""}
            if attributes:
                for name, single, double in ATTRIBUTE.findall(attributes):
                    if name in NAMED:
                        row[name] = single or double
            if tag not in VOID:
                row["text"] = len(texts)
                holding.append(row)
                open_tags.append(tag)
            rows.append(row)
        elif closed in open_tags:
            tag = None
            while tag != closed:
                tag = open_tags.pop()
                _close(holding.pop(), texts, place, tags)
    for row in holding:
        _close(row, texts, place, tags)
    return rows if tags is None else [row for row in rows if row["tag"] in tags]


def _close(row: dict, texts: list[str], last: int, tags: Collection[str] | None) -> None:
    row["upto"] = last
    if tags is None or row["tag"] in tags:
        first = row["text"]
        said = texts[first] if len(texts) == first + 1 else "".join(texts[first:])
        row["text"] = " ".join(said.split())


def html_nodes(pages: DataFrame, id_col: str, html_col: str, tags: list[str] | None = None) -> DataFrame:
    """One row an element: ``id``, ``place`` (document order), ``parent``, ``tag``, ``node_id``, ``classes``,
    ``href``, ``onclick``, ``headers``, ``text`` (white space collapsed) and ``upto``, the place of the last element
    inside, so what an element holds are the places after its own up to that. Null pages have no elements."""

    def work(batches):
        fields = ["place", "parent", "tag", "id", "class", "href", "onclick", "headers", "text", "upto"]
        kinds = [pa.int32(), pa.int32()] + [pa.string()] * 7 + [pa.int32()]
        def held(ids, nodes, id_kind):
            columns = [pa.array(ids, id_kind)] + [pa.array([n[f] for n in nodes], k) for f, k in zip(fields, kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["id", "place", "parent", "tag", "node_id", "classes", "href", "onclick", "headers", "text", "upto"])

        for batch in batches:
            ids, nodes, size = [], [], 0
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = parse_nodes(html or "", tags)
                ids += [key] * len(own)
                nodes += own
                size += len(html or "")
                if size > BATCH_CHARACTERS:
                    yield held(ids, nodes, batch.schema.field(0).type)
                    ids, nodes, size = [], [], 0
            yield held(ids, nodes, batch.schema.field(0).type)

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(work, f"id {kind}, place int, parent int, tag string, node_id string, classes string, href string, onclick string, headers string, text string, upto int")


def page_pairs(pages: DataFrame, id_col: str, html_col: str, pairs) -> DataFrame:
    """``id`` and ``pairs`` array<struct<label,value>>, what ``pairs`` makes of a page's ``th`` and ``td`` (dicts with ``tag``,
    ``headers`` and ``text``, in document order). One row a page that has some: its elements are neither rows nor shuffled."""

    def work(batches):
        for batch in slices(batches):
            ids, ends, labels, values = [], [0], [], []
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = pairs(parse_cells(html or ""))
                if found:
                    ids.append(key)
                    labels += found
                    values += found.values()
                    ends.append(len(labels))
            held = pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(values, pa.string())], ["label", "value"])
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)], names=["id", "pairs"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(work, f"id {kind}, pairs array<struct<label:string,value:string>>")


def labels_of(nodes: list[dict]) -> dict[str, str]:
    """Labels (``th``, white space dropped) of one page with the ``td`` that follows; the first of equal labels wins."""
    cells = [n for n in nodes if n["tag"] in ("th", "td")]
    found: dict[str, str] = {}
    for label, value in zip(cells, cells[1:]):
        if label["tag"] == "th" and value["tag"] == "td":
            found.setdefault("".join(label["text"].split()), value["text"])
    return found


def links(nodes: DataFrame) -> DataFrame:
    """Distinct targets of each page with the text of the first link to them; fragments are cut off."""
    found = nodes.filter((F.col("tag") == "a") & (F.coalesce("href", F.lit("")) != "")).withColumn("url", F.regexp_replace("href", "#.*$", ""))
    return found.filter("url <> ''").groupBy("id", "url").agg(F.min_by("text", "place").alias("text"), F.min("place").alias("place"))


def label_values(nodes: DataFrame, label_tag: str = "th", value_tag: str = "td") -> DataFrame:
    """Labels (white space dropped) with the value cell that follows; the first of equal labels wins."""
    by = Window.partitionBy("id").orderBy("place")
    cells = nodes.filter(F.col("tag").isin(label_tag, value_tag)).withColumn("after", F.lead(F.struct("tag", "text")).over(by))
    pairs = cells.filter((F.col("tag") == label_tag) & (F.col("after.tag") == value_tag)).select("id", F.regexp_replace("text", r"(?U)\s+", "").alias("label"), F.col("after.text").alias("value"), "place")
    return pairs.groupBy("id", "label").agg(F.min_by("value", "place").alias("value"))


def has_class(name: str) -> Column:
    return F.array_contains(F.split(F.coalesce("classes", F.lit("")), r"\s+"), name)


def inside(nodes: DataFrame, name: str, holder: Column) -> DataFrame:
    """Elements with ``name``: ``place``, ``upto`` and ``text`` of the last element at or before them, in document
    order, that ``holder`` is true of and that holds them; null where none does."""
    by = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(holder, F.struct("place", "upto", "text")), True).over(by)
    return nodes.withColumn(name, last).withColumn(name, F.when((F.col("place") > F.col(f"{name}.place")) & (F.col("place") <= F.col(f"{name}.upto")), F.col(name)))


def captioned(nodes: DataFrame, caption_tag: str = "h2", item_tag: str = "p") -> DataFrame:
    """Items with the caption that was last seen before them."""
    by = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = nodes.filter(F.col("tag").isin(caption_tag, item_tag)).withColumn("caption", F.last(F.when(F.col("tag") == caption_tag, F.col("text")), True).over(by))
    return seen.filter(F.col("tag") == item_tag).select("id", "place", "caption", "text")


def case_id(onclick: Column) -> Column:
    return F.nullif(F.regexp_extract(onclick, r"id=(\d+)", 1), F.lit(""))


def title_of(html: Column) -> Column:
    """Title of a page by pattern, without parsing it."""
    return F.nullif(F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " ")), F.lit(""))


def is_html(content: Column) -> Column:
    """Whether bytes begin like an HTML page and not like XML data."""
    head = F.lower(F.ltrim(F.substring(content, 1, 2048).cast("string")))
    return head.rlike("^(<!doctype html|<html)")
