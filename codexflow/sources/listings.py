"""Lists and details of public corpora: proceedings, bills, ordinances, circulars, councils, update batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codexflow.functions import gazette
from codexflow.functions.text import after_mark, before_mark, chamber
from codexflow.sources import markup
from codexflow.sources.corpora import ordinance_articles
from codexflow.sources.lawxml import law_ids
from codexflow.sources.markup import links

#: The sets of circulars that are known, their contents pages and the laws they explain.
CIRCULARS = [
    ("shotoku", "所得税基本通達", "kihon/shotoku/01.htm", "340AC0000000033", "所得税法"),
    ("hojin", "法人税基本通達", "kihon/hojin/01.htm", "340AC0000000034", "法人税法"),
    ("shohi", "消費税法基本通達", "kihon/shohi/01.htm", "363AC0000000108", "消費税法"),
    ("sozoku", "相続税法基本通達", "kihon/sisan/sozoku2/01.htm", "325AC0000000073", "相続税法"),
    ("hyoka", "財産評価基本通達", "kihon/sisan/hyoka_new/01.htm", "325AC0000000073", "相続税法"),
]
#: The municipality whose ordinances are known, by its code.
MUNICIPALITIES = [("121002", "千葉市", "chiba")]
#: Labels of a bill's progress page and the fields they fill.
PROGRESS = {"議案種類": "bill_type", "議案番号": "number", "議案件名": "title", "議案提出者": "submitter", "議案提出会派": "parties"}
#: What the address of a council's minutes holds.
MINUTES = ["gijiroku", "gijiyoshi", "kaigiroku", "minutes"]


def circular_sets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CIRCULARS, "tax string, name string, index_path string, parent_law_id string, parent_law_title string")


def municipalities(spark: SparkSession, wanted: list[str] = ()) -> DataFrame:
    """Known municipalities, all of them if none is named."""
    rows = spark.createDataFrame(MUNICIPALITIES, "code string, name string, slug string")
    return rows.filter(F.col("code").isin(*wanted)) if wanted else rows


def before_empty(pages: DataFrame, listing: str, number: str, items: str) -> DataFrame:
    """Items of the pages of each listing before its first empty page."""
    empty = F.when(F.coalesce(F.size(items), F.lit(0)) < 1, F.col(number))
    first = pages.groupBy(listing).agg(F.min(empty).alias("stop_"))
    return pages.join(first, listing).filter(F.col("stop_").isNull() | (F.col(number) < F.col("stop_"))).select(listing, number, F.explode(items).alias("item"))


def fetched(listed: DataFrame, bodies: DataFrame, key: str) -> DataFrame:
    """What a list names and was fetched; what couldn't be fetched is left out."""
    return listed.dropDuplicates([key]).join(bodies, key)


def update_batch(lists: DataFrame, bodies: DataFrame, xml_col: str, key: str = "law_id") -> DataFrame:
    """Bodies of the laws that the update lists name; a list that failed names none."""
    ids = lists.select(F.explode(law_ids(F.col(xml_col))).alias(key)).distinct()
    return ids.join(bodies, key)


def bulk(rows: DataFrame, category: str, wanted: str, order: str, limit: int, tasks: int = 2) -> DataFrame:
    """The first rows of a category, dealt to a number of tasks for what follows."""
    return rows.filter(F.col(category) == wanted).orderBy(order).limit(limit).repartition(tasks)


def meeting_list(text: DataFrame, json_col: str) -> DataFrame:
    """Meetings of list responses: by ``issueID``, else ``meetingId``; those without a key or a session are left
    out; the stated number of speeches, else that of the record."""
    record = "struct<issueID:string,meetingId:string,session:string,nameOfHouse:string,nameOfMeeting:string,date:string,issue:string,numberOfSpeech:string,speechRecord:array<map<string,string>>>"
    m = text.select(F.explode(F.from_json(json_col, f"meetingRecord array<{record}>")["meetingRecord"]).alias("m")).select("m.*")
    counted = F.coalesce(F.expr("try_cast(numberOfSpeech as int)"), F.greatest(F.size("speechRecord"), F.lit(0)))
    rows = m.select(F.coalesce(F.nullif("issueID", F.lit("")), F.nullif("meetingId", F.lit(""))).alias("meeting_id"), F.expr("try_cast(session as int)").alias("session"), chamber(F.coalesce("nameOfHouse", F.lit(""))).alias("house"), F.col("nameOfMeeting").alias("committee"), F.coalesce("date", F.lit("")).alias("date"), "issue", F.coalesce(counted, F.lit(0)).alias("speech_count"))
    return rows.filter("meeting_id is not null and session is not null")


def bill_progress(nodes: DataFrame) -> DataFrame:
    """One row a progress page: labels and values of its two columns, zipped in order; of equal labels the first
    counts. Committee and result are those of the lower house, else those of the upper."""
    by = Window.partitionBy("id", "headers").orderBy("place")
    cells = nodes.filter((F.col("tag") == "td") & F.col("headers").isin("KOMOKU", "NAIYO")).withColumn("n", F.row_number().over(by))
    pairs = cells.groupBy("id", "n").agg(F.max(F.when(F.col("headers") == "KOMOKU", F.col("text"))).alias("label"), F.max(F.when(F.col("headers") == "NAIYO", F.col("text"))).alias("value"))
    kept = pairs.filter("label <> '' and value is not null").groupBy("id", "label").agg(F.nullif(F.min_by("value", "n"), F.lit("")).alias("value"))
    return _progress(kept.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("label", "value"))).alias("f")))


def progress_of(nodes: list[dict]) -> dict[str, str | None]:
    """Labels and values of one progress page."""
    texts = [[n["text"] for n in nodes if n["tag"] == "td" and n["headers"] == name] for name in ("KOMOKU", "NAIYO")]
    found: dict[str, str | None] = {}
    for label, value in zip(*texts):
        if label:
            found.setdefault(label, value or None)
    return found


def bill_progress_pages(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """What ``bill_progress`` gives, of pages whose ids differ, without a shuffle."""
    return _progress(markup.page_pairs(pages, id_col, html_col, progress_of).select("id", F.map_from_entries("pairs").alias("f")))


def _progress(wide: DataFrame) -> DataFrame:
    get = lambda label: F.try_element_at("f", F.lit(label))
    said = lambda what: F.coalesce(*[after_mark(get(what.format(house))) for house in ("衆議院", "参議院")])
    law = get("公布年月日／法律番号")
    return wide.select(
        "id", *[get(k).alias(n) for k, n in PROGRESS.items()],
        F.regexp_replace(get("議案提出回次"), "[^0-9]", "").try_cast("int").alias("session"),
        said("{0}付託年月日／{0}付託委員会").alias("committee"), said("{0}審議終了年月日／{0}審議結果").alias("result"),
        before_mark(law).alias("promulgated"), after_mark(law).alias("law_num"),
    )


def _file(href: Column) -> Column:
    return F.regexp_extract(href, r"([^/]*)$", 1)


def _anchors(nodes: DataFrame) -> DataFrame:
    return nodes.filter((F.col("tag") == "a") & F.col("href").isNotNull())


def ordinance_pages(nodes: DataFrame) -> DataFrame:
    """Distinct list pages that an index of ordinances links to."""
    return _anchors(nodes).select("id", _file(F.col("href")).alias("page")).filter(F.col("page").rlike(r"^r_50_.*\.html$")).distinct()


def ordinance_list(nodes: DataFrame, code: Column) -> DataFrame:
    """Ordinances that a list page links to, by the municipality's code and the file; the first title of each."""
    held = _anchors(nodes).filter(F.contains("href", F.lit("reiki_honbun")) & (F.col("text") != "")).withColumn("file", _file(F.col("href"))).filter("file <> ''")
    name = F.concat(code, F.lit("_"), F.regexp_replace("file", r"(\.html)+$", ""))
    return held.groupBy(name.alias("ordinance_id"), "file").agg(F.min_by("text", "place").alias("title"))


def ordinance_documents(nodes: DataFrame) -> DataFrame:
    """Title, number and articles of each page; without article blocks the body stands for them. The number is
    looked for in the text before the first article."""
    articles = ordinance_articles(nodes)
    listed = articles.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "article_no", "text"))).alias("articles"))
    body = nodes.groupBy("id").agg(F.min_by(F.when(F.col("tag") == "body", F.col("text")), F.when(F.col("tag") == "body", F.col("place"))).alias("body"), F.min_by(F.when(F.col("tag").isin("title", "h1"), F.col("text")), F.when(F.col("tag").isin("title", "h1"), F.col("place"))).alias("title"))
    joined = body.join(listed, "id", "left")
    head = F.expr("if(articles is null, body, left(body, position(articles[0].text, body) - 1))")
    fallback = F.when(F.coalesce("body", F.lit("")) != "", F.array(F.struct(F.lit(0).alias("place"), F.lit(None).cast("string").alias("article_no"), F.col("body").alias("text"))))
    return joined.select("id", "title", gazette.enactment_number(head).alias("number"), F.coalesce("articles", fallback).alias("articles"))


def circular_pages(nodes: DataFrame) -> DataFrame:
    """Text pages that a circular's contents link to: below ``kihon``, in a folder named by a number."""
    page = links(nodes).select("id", "url").filter(F.contains("url", F.lit("/kihon/")))
    return page.filter(F.regexp_replace("url", r"\?.*$", "").rlike(r"(^|/)[0-9]+/+[^/]+\.htm$")).distinct()


def committees(nodes: DataFrame) -> DataFrame:
    """Names of the councils that a list links to, in order."""
    return _anchors(nodes).filter(F.col("href").rlike("shingi|kenkyukai") & (F.col("text") != "")).select("id", "place", F.col("text").alias("committee"))


def minutes_list(nodes: DataFrame, ministry: Column, committee: Column, base: str) -> DataFrame:
    """Minutes that a council's page links to, with absolute addresses."""
    held = _anchors(nodes).filter(F.lower("href").rlike("|".join(MINUTES)) & (F.col("text") != ""))
    url = F.when(F.startswith("href", F.lit("http")), F.col("href")).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace("href", "^/+", "")))
    name = F.concat_ws("_", ministry, F.left(committee, F.lit(10)), F.regexp_replace(_file(F.col("href")), r"(\.html)+$", ""))
    return held.select("id", "place", name.alias("minutes_id"), F.col("text").alias("title"), url.alias("detail_url"))


def minutes_documents(nodes: DataFrame) -> DataFrame:
    """Text of each page (its main part, else its body) and the addresses of its attached files."""
    named = F.coalesce(F.col("classes"), F.lit(""))
    main = F.col("tag").isin("article", "main") | ((F.col("tag") == "div") & (named.rlike(r"(^|\s)(contents|main)(\s|$)") | F.coalesce(F.col("node_id") == "main", F.lit(False))))
    pick = lambda hit: F.min_by(F.when(hit, F.col("text")), F.when(hit, F.col("place")))
    files = F.array_sort(F.collect_list(F.when((F.col("tag") == "a") & F.coalesce(F.col("href").rlike(r"\.(pdf|PDF)$"), F.lit(False)), F.struct("place", "href"))))
    grouped = nodes.groupBy("id").agg(pick(main).alias("main"), pick(F.col("tag") == "body").alias("body"), files.alias("files"))
    return grouped.select("id", F.coalesce("main", "body", F.lit("")).alias("body_text"), F.transform("files", lambda f: f["href"]).alias("attachments"))
