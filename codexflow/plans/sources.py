"""Parsed pages and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.plans.base import Tables, query
from codexflow.sources import lawstream, markup


@query(r"select page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), '') as title from pages")
def html_title(t: Tables) -> DataFrame:
    return t.pages.select("page_id", markup.title_of(F.col("html")).alias("title"))


@query()
def html_links(t: Tables) -> DataFrame:
    found = markup.links(markup.html_nodes(t.pages, "page_id", "html", ["a"]))
    return found.select(F.col("id").alias("page_id"), "url", "text")


@query()
def html_text(t: Tables) -> DataFrame:
    nodes = markup.html_nodes(t.pages, "page_id", "html", ["body"])
    return nodes.groupBy(F.col("id").alias("page_id")).agg(F.min_by("text", "place").alias("text"))


@query()
def html_captioned(t: Tables) -> DataFrame:
    found = markup.captioned(markup.html_nodes(t.pages, "page_id", "html", ["h1", "p"]), "h1", "p")
    return found.select(F.col("id").alias("page_id"), "place", "caption", "text")


@query("select doc_id, sha256(coalesce(text, '')) as sha256, octet_length(encode(coalesce(text, '')))::bigint as bytes from documents")
def manifest_documents(t: Tables) -> DataFrame:
    content = F.coalesce(F.col("text"), F.lit(""))
    return t.documents.select("doc_id", F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("bytes"))


@query("select page_id, (contains(lower(ltrim(substr(html, 1, 2048))), '<!doctype html') and starts_with(lower(ltrim(html)), '<!doctype html')) or starts_with(lower(ltrim(html)), '<html') as is_html from pages")
def html_sniff(t: Tables) -> DataFrame:
    return t.pages.select("page_id", markup.is_html(F.col("html").cast("binary")).alias("is_html"))


def _law_xml(t: Tables) -> DataFrame:
    """``law_id`` and ``xml``: a law of every document. The first half of its lines are articles of the main provision, the
    others of a supplementary one, what ends in a stop and a blank is a paragraph; a table of contents stands before."""
    escaped = F.replace(F.replace(F.replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x08\x0B-\x1F]", ""), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    lines = F.split(escaped, "\n")
    paragraph = lambda s, j: F.concat(F.lit("<Paragraph><ParagraphNum>"), (j + 1).cast("string"), F.lit("</ParagraphNum><ParagraphSentence>［"), s, F.lit("］</ParagraphSentence></Paragraph>"))
    article = lambda line, i: F.concat(
        F.lit('<Article Num="'), (i + 1).cast("string"), F.lit('"><ArticleTitle>'), (i + 1).cast("string"), F.lit("</ArticleTitle>"), F.array_join(F.transform(F.split(line, r"\. "), paragraph), ""), F.lit("</Article>")
    )
    half = F.expr("(size(lines) + 1) div 2").cast("int")
    written = lambda part: F.array_join(F.transform(part, article), "\n")
    named = t.documents.select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"), F.coalesce("source", F.lit("none")).alias("source"), lines.alias("lines"))
    return named.select(
        F.col("doc_id").alias("law_id"),
        F.concat(
            F.lit('<DataRoot><ApplData><Law Era="Reiwa" Year="5" PromulgateMonth="06" PromulgateDay="14"><LawNum>'), "source", F.lit("</LawNum><LawBody><LawTitle>"), "lang",
            F.lit('</LawTitle><TOC><Article Num="9"><Paragraph><Sentence>apart</Sentence></Paragraph></Article></TOC><MainProvision><Chapter Num="1">'), written(F.slice("lines", F.lit(1), half)),
            F.lit('</Chapter></MainProvision><SupplProvision AmendLawNum="'), "source", F.lit('"><SupplProvisionLabel>'), "lang", F.lit("</SupplProvisionLabel>"), written(F.slice("lines", half + 1, F.size("lines"))),
            F.lit("</SupplProvision></LawBody></Law></ApplData></DataRoot>"),
        ).alias("xml"),
    )


_LAW_PARTS = r"""d as (select doc_id, string_split(regexp_replace(coalesce(text, ''), '[\x00-\x08\x0B-\x1F]', '', 'g'), chr(10)) as lines from documents),
l as (select doc_id, (len(lines) + 1) // 2 as half, unnest(lines) as line, generate_subscripts(lines, 1) as i from d),
p as (select doc_id, half, i, unnest(string_split(line, '. ')) as s, generate_subscripts(string_split(line, '. '), 1) as j from l)"""


@query(f"""with {_LAW_PARTS} select doc_id as law_id, case when i <= half then 'art_' || i else 'suppl1_art_' || (i - half) end as article_id, (i > half)::int as provision,
(j - 1)::int as at, j::varchar as paragraph_no, md5('［' || s || '］') as text_md5 from p""")
def law_xml_paragraphs(t: Tables) -> DataFrame:
    """Paragraphs of all laws, read by events from their XML."""
    found = lawstream.paragraphs(lawstream.law_rows(_law_xml(t)))
    return found.select("law_id", "article_id", "provision", "at", "paragraph_no", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"""with {_LAW_PARTS} select doc_id as law_id, coalesce(source, 'none') as law_num, coalesce(lang, 'none') as title, '2023-06-14' as promulgated,
(select count(*) from l where l.doc_id = documents.doc_id)::bigint as articles, coalesce(source, 'none') as amend_law_num, coalesce(lang, 'none') as label from documents""")
def law_xml_heads(t: Tables) -> DataFrame:
    """Heads, supplementary provisions and numbers of articles of all laws, read by events from their XML."""
    one = lambda name, kind: F.max(F.when(F.col("kind") == kind, F.col(name))).alias(name)
    rows = lawstream.law_rows(_law_xml(t))
    return rows.groupBy("law_id").agg(one("law_num", "law"), one("title", "law"), one("promulgated", "law"), F.count_if(F.col("kind") == "article").alias("articles"), one("amend_law_num", "provision"), one("label", "provision"))
