"""Dates: eras, written Japanese dates, ISO normalisation and feed formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexflow.functions.text import digits_only, narrow_digits

#: The year before the first of each era, by its English and its Japanese name.
ERAS = {"Meiji": 1867, "Taisho": 1911, "Showa": 1925, "Heisei": 1988, "Reiwa": 2018}
WRITTEN_ERAS = {"明治": 1867, "大正": 1911, "昭和": 1925, "平成": 1988, "令和": 2018}


def _base(name: Column, eras: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for era, base in eras.items():
        out = F.when(name == era, base).otherwise(out)
    return out


def iso_date(year: Column, month: Column, day: Column) -> Column:
    return F.when(
        year.isNotNull() & month.between(1, 12) & day.between(1, 31),
        F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int")),
    )


def era_date(era: Column, year: Column, month: Column, day: Column) -> Column:
    """ISO date of attributes with an English era; null if one is missing or unknown."""
    return iso_date(_base(era, ERAS) + year, month, day)


def written_date(text: Column) -> Column:
    """ISO date of an era date as it is written in Japanese, digits of either width."""
    bare = F.regexp_replace(text, r"(?U)\s+", "")
    part = lambda i: F.regexp_extract(bare, "(明治|大正|昭和|平成|令和)([0-9０-９元]+)年([0-9０-９]+)月([0-9０-９]+)日", i)
    number = lambda i: digits_only(part(i)).try_cast("int")
    return iso_date(_base(part(1), WRITTEN_ERAS) + number(2), number(3), number(4))


def normal_date(text: Column) -> Column:
    """ISO dates stay, ``Y年M月D日`` becomes ISO, all else stays as it is."""
    bare = narrow_digits(text)
    number = lambda i: F.regexp_extract(bare, r"^\s*(\d{4})年\s*(\d{1,2})月\s*(\d{1,2})日", i).try_cast("int")
    return F.coalesce(iso_date(number(1), number(2), number(3)), text)


def is_iso(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$")


def feed_date(day: Column) -> Column:
    """RFC 822 form, at midnight."""
    return F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss '+0000'")


def date_in_id(text: Column) -> Column:
    """The eight digits between underscores (or before the end) of a revision id."""
    return F.nullif(F.regexp_extract(text, r"_(\d{8})(?:_|$)", 1), F.lit(""))


def today_in(zone: str = "Asia/Tokyo") -> Column:
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), zone))
