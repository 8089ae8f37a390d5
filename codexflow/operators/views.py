"""What the pages of the site show: filters by text and kind, orders of lists, counts of cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codexflow.functions.dates import is_iso
from codexflow.operators.ordering import total_order

#: A field of a bill's page that says nothing.
NOTHING = ["", "／"]
#: The modes of a list of comment cases, by what they ask for.
MODES = {"open": ["0"], "closed": ["1"], "all": ["0", "1"]}
#: Events of a law's history by the code of the amendment.
EVENTS = {"1": "enactment", "3": "amendment", "8": "repeal"}


def with_text(rows: DataFrame, needle: str, cols: list[str]) -> DataFrame:
    """Rows of which one of the columns holds the needle, whatever its case; an empty needle keeps all."""
    if not needle:
        return rows
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(needle.lower()))
    return rows.filter(hit)


def selected(rows: DataFrame, col: str, wanted: list) -> DataFrame:
    """Rows with one of the wanted values; an empty list keeps all."""
    return rows.filter(F.col(col).isin(*wanted)) if wanted else rows


def filled_fields(fields: Column) -> Column:
    """Of an array of (label, value) those that say something."""
    return F.filter(fields, lambda f: ~F.coalesce(F.trim(f["value"]), F.lit("")).isin(*NOTHING))


def matching_items(items: Column, needle: str, names: list[str]) -> Column:
    """Of an array of structs those of which a named field holds the needle, whatever its case."""
    def hit(x: Column) -> Column:
        found = F.lit(False)
        for n in names:
            found = found | F.contains(F.lower(F.coalesce(x[n], F.lit(""))), F.lit(needle.lower()))
        return found

    return F.filter(items, hit) if needle else items


def linked_with_file(events: DataFrame, link: str = "kanpo") -> DataFrame:
    """Events whose gazette link holds and leads to a file."""
    return events.filter(F.coalesce(F.col(f"{link}.linked"), F.lit(False)) & (F.coalesce(F.col(f"{link}.pdf_url"), F.lit("")) != ""))


def placed(rows: DataFrame, lead: Column, rest: list[Column], ascending: bool = False, name: str = "place") -> DataFrame:
    """``rows`` with their places, from 1, in the order of ``lead`` and then of ``rest``; nulls of ``lead`` come last.

    Rows are dealt out by ranges of the whole order, so a value of ``lead`` that half of them share is split like the others,
    as far as ``rest`` tells its rows apart.
    """
    order = lead.asc_nulls_last() if ascending else lead.desc_nulls_last()
    return total_order(rows, [order, *rest], name).withColumn(name, F.col(name) + 1)


def ranked(rows: DataFrame, group: str, order: list[Column], most: int | None = None, name: str = "place") -> DataFrame:
    """Places of rows within their group; with ``most`` the first of each alone."""
    out = rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return out if most is None else out.filter(F.col(name) <= most)


def timeline(versions: DataFrame, entity: str, dates: list[str], position: str) -> DataFrame:
    """Places in a law's timeline: by the first of the dates that is there, newest first; equal ones keep their order."""
    day = F.coalesce(*[F.nullif(F.col(d), F.lit("")) for d in dates])
    return ranked(versions.withColumn("day", day), entity, [F.col("day").desc_nulls_last(), F.col(position).asc()])


def recent_updates(updates: DataFrame, latest: DataFrame, date_col: str = "date", days: int = 14) -> DataFrame:
    """Rows of the newest ISO dates, and those of ``latest`` whose date isn't among them."""
    dated = updates.filter(is_iso(F.col(date_col)))
    dates = dated.select(date_col).distinct().orderBy(F.col(date_col).desc()).limit(days)
    own = dated.join(F.broadcast(dates), date_col, "left_semi")
    other = latest.filter(is_iso(F.col(date_col))).join(F.broadcast(dates), date_col, "left_anti")
    return own.unionByName(other)


def flat_issues(days: DataFrame, date_col: str = "date", issues: str = "issues") -> DataFrame:
    """One row an issue of every gazette day, days without one left out."""
    return days.select(date_col, F.inline(issues))


def references_by_article(refs: DataFrame, source: str, target: str) -> DataFrame:
    """``article``, ``direction`` and the number of references that leave it or lead to it, with the first few others.

    Others are kept by a ``min`` and a count, not listed: an article that everything refers to stays one row.
    """
    out = refs.select(F.col(source).alias("article"), F.lit("from").alias("direction"), F.col(target).alias("other"))
    into = refs.select(F.col(target).alias("article"), F.lit("to").alias("direction"), F.col(source).alias("other"))
    return out.union(into).groupBy("article", "direction").agg(F.count("*").alias("n"), F.min("other").alias("least"), F.max("other").alias("most"))


def last_page(index_html: Column) -> Column:
    """The largest number that a link to a page file has."""
    found = F.regexp_extract_all(index_html, F.lit(r"(\d{4})f\.html"), F.lit(1))
    return F.array_max(F.transform(found, lambda x: x.cast("int")))


def case_status(mode: Column) -> Column:
    return F.when(mode == "0", "open").otherwise("closed")


def modes_for(wanted: str) -> list[str]:
    return MODES.get(wanted, MODES["all"])


def filled_from(rows: DataFrame, listed: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Details with what they leave null taken from the list's row of the same key."""
    other = listed.select(key, *[F.col(c).alias(f"listed_{c}") for c in cols])
    joined = rows.join(other, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"listed_{c}")) for c in cols}).drop(*[f"listed_{c}" for c in cols])


def detail_of_listed(listed: DataFrame, cols: list[str], missing: dict[str, str], fetched: Column) -> DataFrame:
    """Details of cases of which only the list is known: what a list doesn't say is null."""
    return listed.select(*cols, *[F.lit(None).cast(kind).alias(c) for c, kind in missing.items()], fetched.alias("fetched_at"))


def event_type(code: Column) -> Column:
    out = F.lit("snapshot")
    for key, name in EVENTS.items():
        out = F.when(code == key, name).otherwise(out)
    return out


def shown_in(stamp: Column, zone: str = "Asia/Tokyo") -> Column:
    """A UTC time as it is shown in a zone."""
    return F.date_format(F.from_utc_timestamp(stamp, zone), "yyyy-MM-dd HH:mm")


def grouped_index(rows: DataFrame, group: str, title: str) -> DataFrame:
    """Of every municipality or ministry the number of its rows, of distinct titles, and the first title."""
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.countDistinct(title).alias("titles"), F.min(title).alias("first"))


def held(cache: DataFrame, entity: str) -> DataFrame:
    """Entities with a cached row, and how many."""
    return cache.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.count("*").alias("entries"))
