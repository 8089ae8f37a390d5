"""Rows of the corpora for the search index and for feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.functions.dates import is_iso
from codexflow.operators.index import appended_forms
from codexflow.operators.publish import newest_dates

#: How changes are named in a feed.
CHANGES = {"added": "新規", "amended": "改正", "repealed": "廃止"}


def _text(*cols: str) -> list[Column]:
    return [F.nullif(F.col(c), F.lit("")) for c in cols]


def law_rows(laws: DataFrame, thesaurus: dict[str, list[str]] | None = None) -> DataFrame:
    """One row an article: ``heading`` of title and number, ``content`` of its number, caption and paragraphs, and
    below these, with a thesaurus, all forms of the entries of which the content holds one. Supplementary
    provisions have no rows."""
    article = laws.select("law_id", "title", "law_num", F.explode("articles").alias("a"))
    body = F.array_join(F.transform("a.paragraphs", lambda p: F.coalesce(p.text, F.lit(""))), "\n")
    rows = article.select("law_id", "a.article_id", F.concat_ws(" ", "title", "law_num").alias("heading"), F.concat_ws(" ", "a.article_no", "a.caption", body).alias("content"))
    if not thesaurus:
        return rows
    forms = appended_forms(rows.withColumn("key", F.struct("law_id", "article_id")), "key", "content", thesaurus)
    said = forms.select("id.law_id", "id.article_id", F.concat(F.lit("\n"), F.array_join("forms", " ")).alias("forms"))
    joined = rows.join(said, ["law_id", "article_id"], "left")
    return joined.select("law_id", "article_id", "heading", F.concat("content", F.coalesce("forms", F.lit(""))).alias("content"))


def speech_rows(speeches: DataFrame, meetings: DataFrame) -> DataFrame:
    """Speeches that say something, with their meeting (of rows that repeat it, the earliest); those of unknown meetings are left out."""
    first = meetings.groupBy("meeting_id").agg(*[F.min_by(c, F.struct("date", "committee")).alias(c) for c in ("committee", "date")])
    return speeches.filter(F.length(F.trim(F.coalesce("speech", F.lit("")))) > 0).join(first, "meeting_id")


def gazette_rows(days: DataFrame) -> DataFrame:
    """Titled items of gazette days; the issue's file stands in for an item's, the first linked law counts."""
    issue = days.select("date", F.explode("issues").alias("i"))
    item = issue.select("date", F.col("i.pdf_url").alias("issue_pdf"), F.explode("i.items").alias("x"))
    return item.filter(F.coalesce("x.title", F.lit("")) != "").select(
        "date", "x.title", "x.page", F.coalesce(F.nullif("x.pdf_url", F.lit("")), "issue_pdf").alias("pdf_url"), F.get("x.linked_laws", F.lit(0))["law_id"].alias("law_id"), "x.amend_text"
    )


def circular_rows(sets: DataFrame) -> DataFrame:
    """Items of circular sets that have a text."""
    return sets.select("tax", "parent_law_id", F.explode("items").alias("x")).filter(F.coalesce("x.text", F.lit("")) != "").select("tax", "parent_law_id", "x.number", "x.caption", "x.text")


def _feed(kind: str, date: Column, title: Column, link: Column, summary: Column) -> list[Column]:
    return [F.lit(kind).alias("kind"), date.alias("date"), title.alias("title"), link.alias("link"), summary.alias("summary")]


def law_feed(updates: DataFrame, days: int = 14) -> DataFrame:
    """Feed rows of the newest dates' updates that name a law; changes that have no name pass through."""
    named = F.col("change_type")
    for change, name in CHANGES.items():
        named = F.when(F.col("change_type") == change, name).otherwise(named)
    dated = newest_dates(updates.filter(is_iso(F.col("date"))), "date", days)
    kept = dated.filter(is_iso(F.col("date")) & (F.coalesce("law_id", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))
    return kept.select(*_feed("law", F.col("date"), F.col("title"), F.concat(F.lit("/laws/"), "law_id"), named))


def comment_feed(cases: DataFrame) -> DataFrame:
    """Named cases: open ones by their deadline, closed ones by the day of the result; the summary names the law."""
    is_open = F.col("status") == "open"
    summary = F.concat_ws(" · ", F.when(is_open, "意見募集中（締切）"), F.concat(F.lit("関連: "), *_text("related_law_name")))
    rows = cases.filter((F.coalesce("case_id", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))
    date = F.when(is_open, F.col("reception_end")).otherwise(F.col("result_published"))
    return rows.select(*_feed("pubcomment", date, F.col("title"), F.concat(F.lit("/pubcomment/"), "case_id"), F.nullif(summary, F.lit("")))).filter(F.coalesce("date", F.lit("")) != "")


def gazette_feed(items: DataFrame, days: int = 30) -> DataFrame:
    """Items of the newest days that have an amendment text."""
    return newest_dates(items, "date", days).filter(F.coalesce("amend_text", F.lit("")) != "").select(*_feed("gazette", F.col("date"), F.col("title"), F.col("pdf_url"), F.left("amend_text", F.lit(80))))


def bill_feed(bills: DataFrame) -> DataFrame:
    """Bills that have a latest date; the summary joins what is known of them."""
    kept = bills.filter(F.coalesce("latest_date", F.lit("")) != "")
    return kept.select(*_feed("bill", F.col("latest_date"), F.col("title"), F.concat(F.lit("/bills/"), "bill_id"), F.concat_ws(" · ", *_text("bill_type", "status", "latest_event"))))
