"""Law XML read by events: a row an article, so a law's tree is never in memory.

The parser keeps a stack of scopes (main provision, supplementary provision, tables and other matter apart) and
one open article. What an element says is the text between its last inner tag and its end. A document is
checked for well-formedness before the first row leaves it, so one that breaks off gives a single row without articles.

Rows have ``law_id``, ``kind`` and ``place`` (their order in the law). Of kind ``article``: ``provision`` (0 main,
1, 2, ... supplementary) and the ``article``; of kind ``provision``: its number, ``label`` and ``amend_law_num``; of
kind ``law``, once a document: ``law_num``, ``title`` (the id if there is none) and ``promulgated`` (ISO); of kind
``fault``: a null, an empty or a broken document. Paragraphs straight below the main provision become the article
``art_preamble`` if the law has no article of its own.
"""

from __future__ import annotations

import xml.parsers.expat as expat
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.functions.dates import ERAS
from codexflow.sources.lawxml import _A, ARTICLE

#: Elements whose articles are no part of the law, and those whose text makes a paragraph's lines.
APART = {"AppdxTable", "AppdxNote", "AppdxStyle", "AppdxFig", "AppdxFormat", "Appdx", "TOC"}
SENTENCES = {"ParagraphSentence", "Sentence", "ItemSentence", "Subitem1Sentence", "Subitem2Sentence"}
NUMBERED = {"ItemSentence", "Subitem1Sentence", "Subitem2Sentence"}
#: Bytes that are parsed before the articles they hold leave, and articles of a batch.
PIECE, BATCH = 1 << 16, 500
MAIN, OTHER = 0, -1
_FIELDS = [("kind", pa.string()), ("place", pa.int32()), ("provision", pa.int32()), ("article", _A), ("label", pa.string()), ("amend_law_num", pa.string()), ("law_num", pa.string()), ("title", pa.string()), ("promulgated", pa.string())]
SCHEMA = f"kind string, place int, provision int, article {ARTICLE}, label string, amend_law_num string, law_num string, title string, promulgated string"


def _era_day(found: dict[str, str]) -> str | None:
    """ISO date of the attributes of a law; null if one of the four is missing, no number, or no known era."""
    numbers = [found.get(k, "") for k in ("Year", "PromulgateMonth", "PromulgateDay")]
    if found.get("Era") not in ERAS or not all(n.isascii() and n.isdigit() for n in numbers):
        return None
    year, month, day = map(int, numbers)
    return f"{ERAS[found['Era']] + year:04}-{month:02}-{day:02}"


class LawEvents:
    """Takes the events of one document; ``rows`` holds what is finished and not yet taken."""

    def __init__(self):
        self.rows: list[dict] = []
        self.scopes, self.text = [MAIN], []
        self.article: dict | None = None
        self.paragraph: dict | None = None
        self.item: str | None = None
        self.loose: list[dict] = []
        self.place = self.articles = self.provisions = self.own = 0
        self.provision: dict = {}
        self.law: dict = {"law_num": None, "title": None, "promulgated": None}

    def row(self, kind: str, **fields) -> None:
        self.rows.append({"kind": kind, "place": self.place, **fields})
        self.place += 1

    def start(self, name: str, found: dict[str, str]) -> None:
        if name == "Law" and self.law["promulgated"] is None:
            self.law["promulgated"] = _era_day(found)
        elif name == "MainProvision":
            self.scopes.append(MAIN)
        elif name == "SupplProvision":
            self.provisions, self.own = self.provisions + 1, 0
            self.provision = {"provision": self.provisions, "amend_law_num": found.get("AmendLawNum"), "label": None}
            self.scopes.append(self.provisions)
        elif name in APART:
            self.scopes.append(OTHER)
        elif name == "Article":
            scope = self.scopes[-1]
            number = found.get("Num") or str((self.own if scope > 0 else self.articles) + 1)
            self.article = {"article_id": f"suppl{scope}_art_{number}" if scope > 0 else f"art_{number}", "article_no": "", "caption": None, "paragraphs": []}
        elif name == "Paragraph":
            self.paragraph = {"paragraph_no": None, "text": ""}
        elif name == "Item":
            self.item = found.get("Num")
        self.text.clear()

    def end(self, name: str) -> None:
        said = "".join(self.text).strip()
        self.text.clear()
        if name == "LawNum":
            self.law["law_num"] = said
        elif name == "LawTitle":
            self.law["title"] = said
        elif name == "PromulgationDate":
            self.law["promulgated"] = said
        elif name == "SupplProvisionLabel" and said and self.provision:
            self.provision["label"] = said
        elif name == "ArticleTitle" and self.article is not None:
            self.article["article_no"] = said
        elif name == "ArticleCaption" and said and self.article is not None:
            self.article["caption"] = said
        elif name == "ParagraphNum" and said and self.paragraph is not None:
            self.paragraph["paragraph_no"] = said
        elif name in SENTENCES and said and self.paragraph is not None:
            line = f"{self.item} {said}" if name in NUMBERED and self.item is not None else said
            self.paragraph["text"] += f"\n{line}" if self.paragraph["text"] else line
        elif name == "Item":
            self.item = None
        elif name == "Paragraph" and self.paragraph is not None:
            if self.article is not None:
                self.article["paragraphs"].append(self.paragraph)
            elif self.paragraph["text"].strip() and self.scopes[-1] == MAIN and not self.articles:
                self.loose.append(self.paragraph)
            self.paragraph = None
        elif name == "Article" and self.article is not None:
            scope = self.scopes[-1]
            if scope != OTHER:
                self.row("article", provision=scope, article=self.article)
            if scope == MAIN:
                self.articles, self.loose = self.articles + 1, []
            elif scope > 0:
                self.own += 1
            self.article = None
        elif name in APART or name in ("MainProvision", "SupplProvision"):
            if name == "SupplProvision" and self.provision:
                self.row("provision", **self.provision)
            if len(self.scopes) > 1:
                self.scopes.pop()

    def finish(self, law_id) -> None:
        if self.loose and not self.articles:
            self.row("article", provision=MAIN, article={"article_id": "art_preamble", "article_no": "本則", "caption": None, "paragraphs": self.loose})
        self.row("law", **self.law | {"title": str(law_id) if self.law["title"] is None else self.law["title"]})


def well_formed(xml: bytes) -> bool:
    try:
        expat.ParserCreate().Parse(xml, True)
    except expat.ExpatError:
        return False
    return True


def law_events(xml: bytes | None, law_id, piece: int = PIECE) -> Iterator[dict]:
    """Rows of one document, as soon as ``piece`` bytes have been parsed that finish them."""
    if not xml or not well_formed(xml):
        yield {"kind": "fault", "place": 0}
        return
    found, parser = LawEvents(), expat.ParserCreate()
    parser.buffer_text = True
    waiting: list[tuple[str, dict]] = []  # a tag that may turn out to be empty
    apart = [False]  # in a CDATA section, which says nothing

    def begun():
        if waiting:
            found.start(*waiting.pop())

    def start(name, attributes):
        begun()
        waiting.append((name, attributes))

    def end(name):
        at = parser.CurrentByteIndex
        if waiting and xml[at - 2 : at] == b"/>":
            waiting.pop()  # ``<x/>`` neither opens a scope nor ends a text
            return
        begun()
        found.end(name)

    def text(said):
        begun()
        if not apart[0]:
            found.text.append(said)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    parser.StartCdataSectionHandler = lambda: apart.__setitem__(0, True)
    parser.EndCdataSectionHandler = lambda: apart.__setitem__(0, False)
    view = memoryview(xml)
    for at in range(0, len(xml), piece):
        parser.Parse(bytes(view[at : at + piece]), at + piece >= len(xml))
        yield from found.rows
        found.rows.clear()
    found.finish(law_id)
    yield from found.rows


def law_rows(raw: DataFrame, id_col: str = "law_id", xml_col: str = "xml") -> DataFrame:
    """Articles, provisions and heads of the laws in ``xml_col`` (bytes or text), as rows."""

    def work(batches):
        for batch in batches:
            ids = batch.column(0)
            schema = pa.schema([("law_id", ids.type), *_FIELDS])
            held: list[dict] = []
            for k in range(batch.num_rows):
                law_id = ids[k].as_py()
                for row in law_events(batch.column(1)[k].as_py(), law_id):
                    held.append({"law_id": law_id, **row})
                    if len(held) >= BATCH:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held.clear()
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    kind = raw.schema[id_col].dataType.simpleString()
    return raw.select(F.col(id_col), F.col(xml_col).cast("binary")).mapInArrow(work, f"law_id {kind}, {SCHEMA}")


def articles(rows: DataFrame) -> DataFrame:
    """``law_id``, ``provision``, ``place`` and the fields of every article."""
    return rows.filter("kind = 'article'").select("law_id", "provision", "place", "article.*")


def paragraphs(rows: DataFrame) -> DataFrame:
    """``law_id``, ``article_id``, ``provision``, ``at`` (0, 1, ...), ``paragraph_no`` and ``text`` of every paragraph."""
    return articles(rows).select("law_id", "article_id", "provision", F.posexplode("paragraphs").alias("at", "p")).select("law_id", "article_id", "provision", "at", "p.paragraph_no", "p.text")
