"""Goldens of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from codexflow.functions import dates, text


def value(spark, expression, **columns):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
    return row.select(expression.alias("v")).first()["v"]





@pytest.mark.parametrize(
    "given, wanted",
    [
        ("東京駅", ["東京", "京駅"]),
        ("東京駅前", ["東京", "京駅", "駅前"]),
        ("検索", ["検索"]),
        ("Hello World", ["hello", "world"]),
        ("第1条abcの", ["第", "1", "条", "abc", "の"]),
        ("", []),
        (None, []),
    ],
)
def test_tokens(spark, given, wanted):
    row = spark.createDataFrame([(given,)], "x string")
    assert row.select(text.tokens(F.col("x")).alias("v")).first()["v"] == wanted


@pytest.mark.parametrize(
    "function, given, wanted",
    [
        (dates.written_date, "令和 8年 6月12日", "2026-06-12"),
        (dates.written_date, "平成元年１月８日", "1989-01-08"),
        (dates.written_date, "令和8年13月1日", None),
        (dates.normal_date, "2026年6月1日（月）", "2026-06-01"),
        (dates.normal_date, "2026-06-01", "2026-06-01"),
        (dates.normal_date, "未定", "未定"),
        (dates.date_in_id, "129AC_20240401_506AC", "20240401"),
        (dates.date_in_id, "abc", None),
        (text.law_of_basis, "更生保護法第12条第1項", "更生保護法"),
        (text.short_ministry, "法務省保護局総務課", "法務省"),
        (text.plain_number, "2", "2"),
        (text.plain_number, "２−5　", "2-5"),
        (text.digits_only, "第１２号", "12"),
        (text.chamber, "衆議院", "shugiin"),
        (text.title_core, "灯台見学法の一部を改正する法律（令和六年法律第九百号）", "灯台見学法"),
        (text.title_core, "甲を廃止する法律の一部を改正する法律", "甲を廃止する法律"),
        (text.title_core, " 甲を廃止する件", "甲"),
        (text.title_core, "甲に関する件", "甲に関する件"),
        (text.squeeze, " a　 b\n", "a b"),
        (text.escape_markup, "<a & 'b'>", "&lt;a &amp; &apos;b&apos;&gt;"),
        (text.amendment_format, "x\n改正後\n改正前\n", "shinkyu"),
        (text.amendment_format, "第一条中「甲」を「乙」に改める。", "prose"),
        (text.amendment_format, "改正後の規定", "unknown"),
        (text.after_mark, "A／B", "B"),
        (text.after_mark, "A／", None),
        (text.before_mark, "A／B", "A"),
        (text.is_amending_title, "民法の一部改正", True),
        (text.drop_private_use, "ab", "ab"),
    ],
)
def test_scalars(spark, function, given, wanted):
    assert value(spark, function(F.col("x")), x=given) == wanted


def test_era_attributes(spark):
    era = lambda e, y, m, d: value(spark, dates.era_date(F.lit(e), F.lit(y), F.lit(m), F.lit(d)))
    assert era("Meiji", 29, 4, 27) == "1896-04-27"
    assert era("Reiwa", 5, 6, 14) == "2023-06-14"
    assert era("Edo", 1, 1, 1) is None


def test_feed_date(spark):
    assert value(spark, dates.feed_date(F.to_date(F.col("x"))), x="2026-06-01") == "Mon, 01 Jun 2026 00:00:00 +0000"


def test_jaccard_of_nothing(spark):
    assert value(spark, text.bigram_jaccard(F.lit(""), F.lit("a"))) == 0.0
    assert value(spark, text.bigram_jaccard(F.lit("abc"), F.lit("abd"))) == pytest.approx(1 / 3)
