"""Pages of public comment cases: the cards of a list, and a case with its labelled rows and attachments.

Defined results, of both: null and empty pages give no row, values that are empty are null, and pages of one ``id``
are one page. Of equal labels the last of a card counts and the first of a case's tables.
"""

from __future__ import annotations

import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.functions.text import law_of_basis, short_ministry
from codexflow.operators.batches import slices
from codexflow.sources.markup import case_id, has_class, inside, parse_nodes

#: Labels of a card and the fields they fill.
CARD_LABELS = {"案件番号": "own_id", "結果の公示日": "result_published", "結果公示日": "result_published", "案の公示日": "reception_start", "受付締切日時": "reception_end", "所管省庁": "ministry"}
#: Labels of a case's tables, the first that isn't empty fills its field.
CASE_LABELS = {
    "category": ["カテゴリー"],
    "command_title": ["定めようとする命令などの題名", "命令等の題名"],
    "legal_basis": ["根拠法令条項"],
    "reception_start": ["案の公示日", "意見募集開始日"],
    "reception_end": ["受付締切日時", "意見募集終了日"],
    "result_published": ["結果の公示日"],
    "responsible_office": ["（所管省庁・部局名等）", "所管省庁・部局名等", "所管省庁"],
    "opinion_count": ["提出意見数"],
}
#: Fixed value: what an attachment without a name is called.
UNNAMED = "添付"
CASE_TAGS = {"table", "tr", "th", "td", "h1", "a"}
#: White space between the names of classes.
SPACE = re.compile("[ \\t\\n\\x0b\\f\\r]+")
ATTACHMENT = "struct<name: string, url: string>"


def cards(nodes: DataFrame) -> DataFrame:
    """``id`` of the page, ``case_id``, ``title``, ``ministry`` and three dates of each card of a list page.

    The case id stands in the handler of an element of the card, else in its labelled values; a card without one is
    left out. ``title`` is empty if there is none.
    """
    lists = inside(nodes, "list_", (F.col("tag") == "ul") & has_class("egovui-list-comment-list"))
    card = inside(lists, "card", (F.col("tag") == "li") & (F.col("parent") == F.col("list_.place"))).filter("card is not null")
    parts = inside(inside(card, "head", F.col("tag") == "h2"), "detail", has_class("egovui-comment-detail"))
    # The first span of a labelled value is its label, what follows in the element its value. The parts are grouped by labelled value
    # and those by card, without a join: pages that are parsed twice could differ in the order of their cards.
    first = lambda value, hit: F.min(F.when(hit, F.struct("place", value.alias("value"))))
    labels = parts.groupBy("id", F.col("card.place").alias("card"), F.col("detail.place").alias("at"), F.col("detail.text").alias("whole")).agg(
        first(case_id(F.col("onclick")), has_class("egovui-link-area-cursor") & case_id(F.col("onclick")).isNotNull()).alias("case"),
        first(F.col("text"), F.col("head").isNotNull() & has_class("egovui-link")).alias("title"),
        F.min_by("text", F.when((F.col("tag") == "span") & F.col("detail").isNotNull(), F.col("place"))).alias("label"),
    )
    value = F.when(F.startswith("whole", F.col("label")), F.substr("whole", F.length("label") + 1)).otherwise(F.col("whole"))
    labels = labels.withColumn("value", F.trim(value))
    filled = {}
    for label, name in CARD_LABELS.items():
        filled.setdefault(name, []).append(label)
    own = [F.min("case")["value"].alias("case_id"), F.coalesce(F.min("title")["value"], F.lit("")).alias("title")]
    found = labels.groupBy("id", "card").agg(*own, *[F.nullif(F.max_by("value", F.when(F.col("label").isin(*names), F.col("at"))), F.lit("")).alias(name) for name, names in filled.items()])
    return found.withColumn("case_id", F.coalesce("case_id", "own_id")).filter("case_id is not null").select("id", "case_id", "title", "ministry", "reception_start", "reception_end", "result_published")


def cases(nodes: DataFrame, base_url: str) -> DataFrame:
    """One row a page that has elements: ``title``, the fields of ``CASE_LABELS``, ``related_law_name``, ``ministry``
    and ``attachments`` (names and whole addresses, in the order of the page).

    The title is the page's heading, else that of the command, else empty. ``opinion_count`` takes the digits of
    its cell and is null where there are none or the number is over 32 bits.
    """
    tables = inside(nodes, "table_", (F.col("tag") == "table") & has_class("egovui-normal-horizontal"))
    rows = inside(tables, "row", (F.col("tag") == "tr") & F.col("table_").isNotNull())
    at = F.when(F.col("table_").isNotNull(), F.col("row.place")).alias("at")  # null outside of such tables and rows
    href = F.coalesce("href", F.lit(""))
    is_file = (F.col("tag") == "a") & (href != "") & (has_class("file") | F.contains(href, F.lit("/pcm/download")))
    url = F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(base_url), href))
    file = F.struct("place", F.coalesce(F.nullif("text", F.lit("")), F.lit(UNNAMED)).alias("name"), url.alias("url"))
    # A page is parsed once: its elements are grouped by row and those by page, in the partitions that the windows have made.
    first = lambda tag: F.min_by("text", F.when((F.col("tag") == tag) & at.isNotNull(), F.col("place"))).alias(tag)
    titled = F.when((F.col("tag") == "h1") & has_class("egovui-article-title"), F.struct("place", "text"))
    parts = rows.groupBy("id", at).agg(first("th"), first("td"), F.min(titled).alias("heading"), F.collect_list(F.when(is_file, file)).alias("files"))
    label = F.when(F.col("td").isNotNull(), F.regexp_replace("th", r"(?U)\s+", ""))
    cell = lambda name: F.nullif(F.min_by("td", F.when(F.col("label") == name, F.col("at"))), F.lit(""))
    pages = parts.withColumn("label", label).groupBy("id").agg(
        *[F.coalesce(*map(cell, names)).alias(field) for field, names in CASE_LABELS.items()],
        F.min("heading")["text"].alias("heading"),
        F.transform(F.array_sort(F.flatten(F.collect_list("files"))), lambda f: F.struct(f["name"].alias("name"), f["url"].alias("url"))).cast(f"array<{ATTACHMENT}>").alias("attachments"),
    )
    return _told(pages)


def _told(pages: DataFrame) -> DataFrame:
    digits = F.regexp_replace("opinion_count", "[^0-9]", "").try_cast("long")
    return pages.select(
        "id", F.coalesce(F.nullif("heading", F.lit("")), "command_title", F.lit("")).alias("title"), short_ministry(F.col("responsible_office")).alias("ministry"),
        *[c for c in CASE_LABELS if c != "opinion_count"], F.when(digits < 1 << 32, digits).alias("opinion_count"), law_of_basis(F.col("legal_basis")).alias("related_law_name"), "attachments",
    )


def case_of(nodes: list[dict], base_url: str) -> tuple[dict[str, str], str | None, list[tuple[str, str]]]:
    """Labels and values of a case's tables, its heading and its files, of a page's elements of ``CASE_TAGS``."""
    table = row = heading = None
    cells: dict[int, dict[str, str]] = {}
    files: list[tuple[str, str]] = []
    for n in nodes:
        tag, place, href = n["tag"], n["place"], n["href"] or ""
        # The last such element before this one counts, if it holds this one.
        held = table is not None and place <= table["upto"]
        if (tag == "th" or tag == "td") and held and row is not None and place <= row["upto"]:
            cells.setdefault(row["place"], {}).setdefault(tag, n["text"])
        elif tag == "tr" and held:
            row = n
        elif tag == "table" and "egovui-normal-horizontal" in _classes(n):
            table = n
        elif tag == "h1" and heading is None and "egovui-article-title" in _classes(n):
            heading = n["text"]
        elif tag == "a" and href and ("/pcm/download" in href or "file" in _classes(n)):
            files.append((n["text"] or UNNAMED, href if href.startswith("http") else base_url + href))
    found: dict[str, str] = {}
    for own in cells.values():
        if "th" in own and "td" in own:
            found.setdefault("".join(own["th"].split()), own["td"])
    return found, heading, files


def _classes(node: dict) -> list[str]:
    return SPACE.split(node["class"] or "")


def case_pages(pages: DataFrame, id_col: str, html_col: str, base_url: str) -> DataFrame:
    """What ``cases`` gives, of pages whose ids differ, without a shuffle."""
    names = [*CASE_LABELS, "heading"]

    def work(batches):
        for batch in slices(batches):
            ids, columns, files = [], [[] for _ in names], []
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes = parse_nodes(html or "", CASE_TAGS)
                if not nodes and not (html and parse_nodes(html)):
                    continue
                found, heading, own = case_of(nodes, base_url)
                ids.append(key)
                files.append(own)
                for column, labels in zip(columns, CASE_LABELS.values()):
                    column.append(next((v for v in map(found.get, labels) if v), None))
                columns[-1].append(heading)
            said = pa.StructArray.from_arrays([pa.array([f[k] for own in files for f in own], pa.string()) for k in range(2)], ["name", "url"])
            listed = pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, files))], pa.int32()), said)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), *[pa.array(c, pa.string()) for c in columns], listed], names=["id", *names, "attachments"])

    kind = pages.schema[id_col].dataType.simpleString()
    return _told(pages.select(id_col, html_col).mapInArrow(work, f"id {kind}, {', '.join(f'{n} string' for n in names)}, attachments array<{ATTACHMENT}>"))
