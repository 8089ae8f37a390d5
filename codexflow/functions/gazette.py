"""Functions for gazette text: vertical forms, margins, boundaries, headings and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexflow.functions.text import drop_private_use

#: Vertical presentation forms and the characters they stand for.
VERTICAL_FORMS = "︐︑︒︓︔︕︖︗︘︙︱︲︳︴︵︶︷︸︹︺︻︼︽︾︿﹀﹁﹂﹃﹄﹇﹈"
UPRIGHT_FORMS = "，、。：；！？〖〗…—–｜｜（）｛｝〔〕【】《》〈〉「」『』〔〕"
#: What is left of a page margin without its digits.
MARGINS = ["官", "報", "令和年月日", "平成年月日", "号外第号", "（号外第号）", "(号外第号)", "月曜日", "火曜日", "水曜日", "木曜日", "金曜日", "土曜日", "日曜日"]
#: Section headings that stand alone on a line and begin another article.
SECTIONS = ["告示", "公告", "公示", "法規的告示", "条約", "庁令", "訓令", "国会事項", "官庁報告", "皇室事項"]
#: Phrases that speak for an amending text.
AMENDING = ["の規定に基づき", "次のように", "に改める", "を加える", "定める"]
#: Kinds of local enactments in the order in which their numbers are looked for.
ENACTMENTS = ["条例", "規則", "規程", "要綱", "訓令", "告示"]


def upright(text: Column) -> Column:
    return F.translate(text, VERTICAL_FORMS, UPRIGHT_FORMS)


def is_margin(line: Column) -> Column:
    """Whether a line is only the margin of a page: its date, weekday or number."""
    return F.regexp_replace(line, r"(?U)[\s0-9０-９]+", "").isin(*MARGINS)


def without_lead(line: Column) -> Column:
    """A line without the single margin character that a wide gap separates from the text."""
    trimmed = F.regexp_replace(line, r"(?U)^\s+", "")
    return F.when(trimmed.rlike(r"(?U)^[官報]\s*$"), F.lit("")).when(trimmed.rlike("^[官報]  "), F.regexp_replace(trimmed, r"(?U)^[官報]\s+", "")).otherwise(line)


def cleaned(text: Column) -> Column:
    """Gazette text with upright forms, without private characters and margins; blank lines collapse."""
    lines = F.transform(F.split(drop_private_use(upright(text)), "\n"), lambda x: F.regexp_replace(without_lead(x), r"(?U)\s+$", ""))
    kept = F.regexp_replace(F.array_join(F.filter(lines, lambda x: ~is_margin(x)), "\n"), r"\n{3,}", "\n\n")
    return F.regexp_replace(kept, r"^\n+|\n+$", "")


def is_boundary(line: Column) -> Column:
    """Whether a line begins another article."""
    bare = F.regexp_replace(line, r"(?U)^\s+|\s+$", "")
    return F.startswith(bare, F.lit("〇")) | F.contains(bare, F.lit("をここに公布する")) | bare.isin(*SECTIONS)


def amending_score(text: Column) -> Column:
    """A thousand for each amending phrase, and one for each character."""
    return sum((F.when(F.contains(text, F.lit(m)), 1000).otherwise(0) for m in AMENDING), F.lit(0)) + F.length(text)


def is_row_heading(line: Column) -> Column:
    bare = F.regexp_replace(line, r"(?U)^\s+|\s+$", "")
    return bare.rlike("^(別表|附則)") | (bare.rlike("^（[^）]{3,}）$") & ~bare.rlike("^（傍線"))


def issue_kind(heading: Column) -> Column:
    """Kind of issue that a heading with a number begins, else null."""
    bare = F.regexp_replace(heading, r"(?U)^\s+", "")
    numbered = F.contains(bare, F.lit("第")) & F.contains(bare, F.lit("号"))
    return F.when(numbered & bare.rlike("^特別号外"), "special_extra").when(numbered & bare.rlike("^号外"), "extra").when(numbered & bare.rlike("^本紙"), "regular")


def issue_number(heading: Column) -> Column:
    return F.nullif(F.regexp_extract(heading, "(第.*?号)", 1), F.lit(""))


def item_title(text: Column) -> Column:
    """A title without the page number that follows it."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"[0-9\s]+$", ""))


def agency(title: Column) -> Column:
    return F.nullif(F.regexp_extract(title, "（([^（）]+)）[^）]*$", 1), F.lit(""))


def enactment_number(text: Column) -> Column:
    """Number of the first kind in order that the text holds with one."""
    found = [F.nullif(F.regexp_extract(text, f"({kind}第[0-9０-９]+)", 1), F.lit("")) for kind in ENACTMENTS]
    return F.concat(F.coalesce(*found), F.lit("号"))


def is_number_like(text: Column) -> Column:
    """Digits of either width, with hyphens and blanks, one digit at least."""
    return text.rlike(r"(?U)^[0-9０-９−－\-ー\s]+$") & text.rlike("[0-9０-９]")
