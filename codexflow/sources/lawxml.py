"""Law documents from their XML: articles, paragraphs and supplementary provisions as nested rows."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.functions.dates import era_date, normal_date

PARAGRAPH = "struct<paragraph_no:string,text:string>"
ARTICLE = f"struct<article_id:string,article_no:string,caption:string,paragraphs:array<{PARAGRAPH}>>"
LAW = f"law_num string, title string, era string, year int, month int, day int, promulgated string, articles array<{ARTICLE}>, suppl_provisions array<struct<index:int,amend_law_num:string,label:string,articles:array<{ARTICLE}>>>"

_P = pa.struct([("paragraph_no", pa.string()), ("text", pa.string())])
_A = pa.struct([("article_id", pa.string()), ("article_no", pa.string()), ("caption", pa.string()), ("paragraphs", pa.list_(_P))])
_S = pa.struct([("index", pa.int32()), ("amend_law_num", pa.string()), ("label", pa.string()), ("articles", pa.list_(_A))])
_KINDS = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(_A), pa.list_(_S)]
#: Elements whose text belongs to no article of the law.
_APART = ("TOC", "Appdx")


def _text(node: ET.Element | None) -> str | None:
    found = " ".join("".join(node.itertext()).split()) if node is not None else ""
    return found or None


def _sentences(node: ET.Element) -> list[str]:
    """Lines of a paragraph: its sentences, and those of its items after their numbers."""
    lines, number = [], None
    for child in node:
        if child.tag.endswith("Title") and child.tag != "ParagraphCaption":
            number = _text(child)
        elif child.tag.endswith("Sentence"):
            said = _text(child)
            if said:
                lines.append(f"{number} {said}" if number and not child.tag.startswith("Paragraph") else said)
        elif child.tag in ("Item",) or child.tag.startswith("Subitem"):
            lines += _sentences(child)
    return lines


def _paragraphs(node: ET.Element) -> list[dict]:
    return [{"paragraph_no": p.get("Num") or _text(p.find("ParagraphNum")) or str(i), "text": "\n".join(_sentences(p))} for i, p in enumerate(node.findall("Paragraph"), 1)]


def _articles(scope: ET.Element, prefix: str) -> list[dict]:
    found = []
    stack = [scope]
    while stack:
        node = stack.pop()
        if node.tag == "Article":
            found.append(node)
        elif not node.tag.startswith(_APART):
            stack += [c for c in reversed(node) if c.tag != "SupplProvision" or node is scope]
    return [
        {
            "article_id": f"{prefix}art_{a.get('Num') or i}",
            "article_no": _text(a.find("ArticleTitle")),
            "caption": _text(a.find("ArticleCaption")),
            "paragraphs": _paragraphs(a),
        }
        for i, a in enumerate(found, 1)
    ]


def parse_law(xml: bytes) -> tuple | None:
    """Fields of a law, or None if the bytes are no law document."""
    try:
        root = ET.parse(io.BytesIO(xml)).getroot()
    except ET.ParseError:
        return None
    law = root if root.tag == "Law" else root.find(".//Law")
    body = law.find("LawBody") if law is not None else None
    if body is None:
        return None
    main = body.find("MainProvision")
    articles = _articles(main, "") if main is not None else []
    if main is not None and not articles:
        loose = _paragraphs(main)
        articles = [{"article_id": "art_preamble", "article_no": "本則", "caption": None, "paragraphs": loose}] if loose else []
    provisions = []
    for i, s in enumerate(body.findall("SupplProvision"), 1):
        own = _articles(s, f"suppl{i}_")
        loose = [] if own else _paragraphs(s)
        if loose:
            own = [{"article_id": f"suppl{i}_art_preamble", "article_no": None, "caption": None, "paragraphs": loose}]
        provisions.append({"index": i, "amend_law_num": s.get("AmendLawNum"), "label": _text(s.find("SupplProvisionLabel")), "articles": own})
    number = lambda k: int(law.get(k)) if (law.get(k) or "").isdigit() else None
    return _text(law.find("LawNum")), _text(body.find("LawTitle")), law.get("Era"), number("Year"), number("PromulgateMonth"), number("PromulgateDay"), _text(law.find("PromulgationDate")), articles, provisions


def law_documents(raw: DataFrame, id_col: str = "law_id", xml_col: str = "xml") -> DataFrame:
    """``law_id`` and the fields of each law; titles default to the id, ``promulgated`` (ISO) to the date of the
    era's attributes; rows that are no law have nulls."""
    names = [f.split()[0] for f in LAW.split(", ") if " " in f][: len(_KINDS)]

    def work(batches):
        for batch in batches:
            rows = [parse_law(x) if x else None for x in batch.column(1).to_pylist()]
            columns = [pa.array([r and r[k] for r in rows], kind) for k, kind in enumerate(_KINDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["law_id", *names])

    kind = raw.schema[id_col].dataType.simpleString()
    found = raw.select(id_col, F.col(xml_col).cast("binary")).mapInArrow(work, f"law_id {kind}, {LAW}")
    dated = F.coalesce(normal_date(F.col("promulgated")), era_date(F.col("era"), F.col("year"), F.col("month"), F.col("day")))
    return found.withColumn("title", F.coalesce("title", F.col("law_id").cast("string"))).withColumn("promulgated", dated)


def law_ids(xml: Column) -> Column:
    """Sorted distinct ids of an update list; none if its result code says that it failed."""
    code = F.trim(F.coalesce(F.xpath_string(xml, F.lit("//Result/Code")), F.lit("")))
    ids = F.concat(F.xpath(xml, F.lit("//LawId/text()")), F.xpath(xml, F.lit("//LawID/text()")))
    return F.when(code.isin("", "0"), F.array_sort(F.array_distinct(ids))).otherwise(F.array().cast("array<string>"))
