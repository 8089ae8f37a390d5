"""Functions for the wording of laws, circulars and gazettes, over texts put together from orders and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.functions import dates, gazette, text
from codexflow.operators import search, segments
from codexflow.plans.base import Tables, query
from codexflow.sources import markup, sinks



def _said(*parts: str | Column) -> Column:
    """Text put together from words and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _wide(col: str) -> Column:
    return F.translate(F.col(col).cast("string"), text.DIGITS, text.WIDE_DIGITS)


def _orders(t: Tables, **columns: Column) -> DataFrame:
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in columns.items()])


@query("select o_orderkey, ['第', o_orderkey::varchar, '条の', 'の改', '改正', 'word', 'é', 'ー'] as tokens from orders")
def tokens_by_script(t: Tables) -> DataFrame:
    return _orders(t, tokens=text.tokens(_said("第", F.col("o_orderkey"), "条の改正、Word-É/ー")))


@query("select o_orderkey, strftime(o_orderdate, '%Y%m%d') as stamp, case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y%m%d') end as last from orders")
def date_in_revision_id(t: Tables) -> DataFrame:
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    return _orders(t, stamp=dates.date_in_id(_said("L1_", stamp, "_a9")), last=dates.date_in_id(F.when(F.col("o_orderkey") % 2 == 0, _said("L_", stamp)).otherwise(_said("L", stamp, "x"))))


@query("select o_orderkey, o_orderpriority || '法' as law, '環境省' as office, '部局' || o_orderkey as other from orders")
def names_in_bases(t: Tables) -> DataFrame:
    return _orders(
        t,
        law=text.law_of_basis(_said(F.col("o_orderpriority"), "法第", F.col("o_orderkey"), "条（抄）")),
        office=text.short_ministry(_said("環境省水局", F.col("o_orderkey"))),
        other=text.short_ministry(_said("部局", F.col("o_orderkey"))),
    )


@query("select o_orderkey, o_orderkey::varchar as clicked, nullif('', '') as none from orders")
def case_id_of_handler(t: Tables) -> DataFrame:
    return _orders(t, clicked=markup.case_id(_said("show('p?id=", F.col("o_orderkey"), "&id=7')")), none=F.nullif(markup.case_id(F.lit("show()")), F.lit("")))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then '規則第' || o_orderkey else '告示第7' end || '号' as number from orders")
def enactment_numbers(t: Tables) -> DataFrame:
    return _orders(t, number=gazette.enactment_number(F.when(F.col("o_orderkey") % 2 == 0, _said("告示第3 規則第", F.col("o_orderkey"), "号 規則第1")).otherwise("訓令 告示第7号")))


@query("select o_orderkey, o_orderpriority || 'を廃止する法' as nested, o_orderpriority as amended, o_orderpriority || '法' as abolished, 'x' || o_orderkey || '（甲' as plain from orders")
def title_cores(t: Tables) -> DataFrame:
    name = F.col("o_orderpriority")
    return _orders(
        t,
        nested=text.title_core(_said(name, "を廃止する法の一部を改正する法律（令和", F.col("o_orderkey"), "）")),
        amended=text.title_core(_said(" ", name, "の一部を改正し、の一部を直す件")),
        abolished=text.title_core(_said(name, "法を廃止する件")),
        plain=text.title_core(_said("x", F.col("o_orderkey"), "（甲（乙")),
    )


@query("select o_orderkey, '（' || o_orderkey || '）。' as upright, 'a' || o_orderkey as bare, '第' || o_orderkey || '号' as number, case o_orderkey % 3 when 0 then 'extra' when 1 then 'regular' end as kind from orders")
def gazette_letters(t: Tables) -> DataFrame:
    head = F.when(F.col("o_orderkey") % 3 == 0, "　号外　").when(F.col("o_orderkey") % 3 == 1, "本紙 ").otherwise("本文 ")
    return _orders(
        t,
        upright=gazette.upright(_said("︵", F.col("o_orderkey"), "︶︒")),
        bare=text.drop_private_use(_said("a", F.col("o_orderkey"), "")),
        number=gazette.issue_number(_said(head, "第", F.col("o_orderkey"), "号")),
        kind=gazette.issue_kind(_said(head, "第", F.col("o_orderkey"), "号")),
    )


@query("select o_orderkey, o_orderkey % 2 = 0 as margin, o_orderkey % 4 = 1 as boundary, o_orderkey % 3 = 0 as heading, case when o_orderkey % 2 = 0 then '' else '第' || o_orderkey || '条' end as led from orders")
def gazette_lines(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return _orders(
        t,
        margin=gazette.is_margin(F.when(key % 2 == 0, _said("令和", _wide("o_orderkey"), "年 ", key, "月日")).otherwise(_said("第", key, "条"))),
        boundary=gazette.is_boundary(F.when(key % 4 == 1, F.when(key % 8 == 1, "　告示　").otherwise(_said("〇第", key, "号"))).otherwise(_said("告示", key))),
        heading=gazette.is_row_heading(F.when(key % 3 == 0, F.when(key % 2 == 0, "（定義等）").otherwise("　附則")).otherwise("（傍線部分）")),
        led=gazette.without_lead(F.when(key % 2 == 0, "　官　").otherwise(_said("報  第", key, "条"))),
    )


@query("select o_orderkey, 'x' || o_orderkey || chr(10) || chr(10) || '本文' as cleaned from orders")
def gazette_text_cleaned(t: Tables) -> DataFrame:
    return _orders(t, cleaned=gazette.cleaned(_said("官\nx", F.col("o_orderkey"), "  \n\n\n\n令和８年６月１２日\n官  本文\n\n")))


@query("select o_orderkey, (case when o_orderkey % 2 = 0 then 1005 else 2014 end + length(o_orderkey::varchar))::bigint as score, case o_orderkey % 3 when 0 then 'shinkyu' when 1 then 'prose' else 'unknown' end as format from orders")
def amending_scores(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    score = gazette.amending_score(F.when(key % 2 == 0, _said("甲に改める", key)).otherwise(_said("次のように、を加える", key, "乙丙丁戊")))
    shape = text.amendment_format(F.when(key % 3 == 0, _said("改正後\n", key, "\n 改正前 ")).when(key % 3 == 1, _said(key, "を削る")).otherwise(_said("改正後と改正前", key)))
    return _orders(t, score=score.cast("long"), format=shape)


@query("select o_orderkey, '省令（水産' || o_orderkey || '）' as title, '水産' || o_orderkey as agency, null::varchar as none, o_orderkey % 2 = 0 as numeral from orders")
def gazette_titles(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    title = gazette.item_title(_said("省令（水産", key, "）  ", key, " 3"))
    return _orders(t, title=title, agency=gazette.agency(title), none=gazette.agency(_said("告示", key)), numeral=gazette.is_number_like(F.when(key % 2 == 0, _said(_wide("o_orderkey"), "−5　")).otherwise(_said("−", "ー"))))


@query("select o_orderkey, 'a_b_c_' || left(o_orderkey::varchar || 'zzzzzzzzzzzzzzzzzzzzzzzz', 18) as name, case o_orderkey % 3 when 0 then 'application/json' when 1 then 'application/zstd' else 'application/octet-stream' end as kind from orders")
def file_names(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return _orders(t, name=text.safe_name(_said("a/b:c\\", key, "z" * 24)), kind=sinks.content_type(F.when(key % 3 == 0, _said("x/", key, ".JSON")).when(key % 3 == 1, _said(key, ".ndjson.zst")).otherwise(_said(key))))


@query("select o_orderkey, 'a' || chr(10) || chr(10) || o_orderkey as squeezed, '第一条 甲乙' || o_orderkey || '。' || chr(10) || '第二条 丙' as joined from orders")
def lines_joined(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return _orders(t, squeezed=segments.squeezed_lines(_said("a\n\n \n\t\n", key)), joined=segments.joined_lines(_said("第一条 甲\n乙", key, "。\n第二条 丙"), "^第[一二]条"))


@query(f"select o_orderkey, o_orderkey % 2 = 0 as iso, strftime(o_orderdate, '%Y-%m-%d') as day, current_date is not null as known from orders")
def iso_days(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return _orders(t, iso=dates.is_iso(F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(F.concat(day, F.lit("T")))), day=day, known=dates.today_in().isNotNull())


@query("select o_orderkey, case o_orderkey % 3 when 0 then ['12', o_orderkey::varchar] when 1 then [o_orderkey::varchar] else []::varchar[] end as articles from orders")
def circular_law_links(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    said = F.when(key % 3 == 0, _said("法第１２条及び、法第", _wide("o_orderkey"), "条")).when(key % 3 == 1, _said("(法第", key, "条の2)、所得税法第9条")).otherwise("民法第1条")
    return _orders(t, articles=text.own_law_articles(said))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then ['the', 'of'] else []::varchar[] end as wanted from orders")
def query_compiled(t: Tables) -> DataFrame:
    some, none = (F.array(*map(F.lit, q)) if q else F.array().cast("array<string>") for q in (search.query_tokens("The (of) a 一"), search.query_tokens("a ー")))
    return _orders(t, wanted=F.when(F.col("o_orderkey") % 2 == 0, some).otherwise(none))


@query("select o_orderkey, case when o_orderkey % 3 = 0 then ['法令 番号', '定款'] else []::varchar[] end as forms from orders")
def query_expansions(t: Tables) -> DataFrame:
    thesaurus = {"規則": ["定款", "法令 番号", "規"], "約款": ["契約"], "_note": ["規則"]}
    found = {q: search.expansions(q, thesaurus) for q in ("規則の改正", "規")}
    lists = {q: F.array_sort(F.array(*map(F.lit, [f for f in x if len(f) > 1]))) if x else F.array().cast("array<string>") for q, x in found.items()}
    return _orders(t, forms=F.when(F.col("o_orderkey") % 3 == 0, F.array_sort(lists["規則の改正"], lambda a, b: F.length(b) - F.length(a))).otherwise(lists["規"]))
