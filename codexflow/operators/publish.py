"""What is published from the corpora: feeds, calendars, facets, indices and upcoming changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the kinds of a feed are called.
KINDS = {"law": "法令", "pubcomment": "意見公募", "gazette": "官報", "bill": "議案"}


def feed(sources: list[DataFrame], limit: int = 200) -> DataFrame:
    """Union of sources (columns ``kind``, ``date``, ``title``, ``link`` ...): newest first, then by kind and
    by the order of the sources; a top-k, so nothing is sorted as a whole."""
    parts = [s.withColumn("seq_", F.lit(i)) for i, s in enumerate(sources)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    rest = [F.col(c).asc() for c in sources[0].columns if c not in ("date", "kind")]
    return out.orderBy(F.col("date").desc(), F.col("kind").asc(), "seq_", *rest).limit(limit).drop("seq_")


def kind_label(kind: Column) -> Column:
    """What a kind is called; an unknown one is its own name."""
    out = kind
    for key, label in KINDS.items():
        out = F.when(kind == key, label).otherwise(out)
    return out


def event_id(*parts: Column | str) -> Column:
    return F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def href(root: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"/{root}/"), F.concat_ws("/", *[p.cast("string") for p in parts]))


def newest_dates(rows: DataFrame, date_col: str, count: int) -> DataFrame:
    """Rows of the ``count`` newest dates. The dates are found by a distinct and a top-k, then semi-joined."""
    dates = rows.select(date_col).distinct().orderBy(F.col(date_col).desc()).limit(count)
    return rows.join(F.broadcast(dates), date_col, "left_semi")


def facets(rows: DataFrame, col: str) -> DataFrame:
    return rows.groupBy(col).agg(F.count("*").alias("n"))


def distinct_values(rows: DataFrame, col: str) -> DataFrame:
    """Values that are neither null nor empty, sorted."""
    return rows.filter(F.col(col).isNotNull() & (F.col(col).cast("string") != "")).select(col).distinct().orderBy(col)


def calendar(rows: DataFrame, day: Column, last: Column, days: int = 14) -> DataFrame:
    """``day`` and ``n`` for each of the days up to ``last``, 0 where there is nothing."""
    counted = rows.groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    spine = rows.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("day"))
    return spine.join(counted, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def upcoming(rows: DataFrame, today: Column, scheduled: Column, effective: Column, id_col: str, limit: int = 1000) -> DataFrame:
    """Rows whose scheduled date, else effective date, lies ahead, with ``date`` and its ``basis``."""
    planned = F.nullif(scheduled, F.lit(""))
    dated = rows.withColumn("date", F.coalesce(planned, F.nullif(effective, F.lit("")))).withColumn("basis", F.when(planned.isNotNull(), "scheduled").otherwise("effective"))
    return dated.filter(F.col("date") > today).orderBy("date", id_col).limit(limit)


def grouped_by_date(rows: DataFrame, date_col: str, row: Column) -> DataFrame:
    return rows.groupBy(date_col).agg(F.array_sort(F.collect_list(row)).alias("items"), F.count("*").alias("n"))


def open_first(is_open: Column, closes: Column, published: Column) -> list[Column]:
    """Order of a comment index: open cases by their end, then closed ones by their result, newest first."""
    return [is_open.desc(), F.when(is_open, closes).asc_nulls_last(), F.when(~is_open, published).desc_nulls_last()]


def open_first_key(is_open: Column, closes: Column, published: Column) -> Column:
    """The same order as one ascending key, of days as numbers."""
    return F.struct((~is_open).alias("late"), F.coalesce(F.when(is_open, closes), F.when(~is_open, -published), F.lit(2**31 - 1)).alias("day"))


def by_title(updated: str, title: str, collation: str = "ja") -> list[Column]:
    """Order of a law list: last updated first, those without a date last, then titles as the language sorts them."""
    return [F.col(updated).desc_nulls_last(), F.collate(F.col(title), collation).asc()]


def latest_event(candidates: list[tuple[str, Column]]) -> Column:
    """Struct ``date``, ``label`` of the newest candidate; equal dates go to the one listed first."""
    rows = [F.struct(d.alias("date"), F.lit(-i).alias("priority"), F.lit(n).alias("label")) for i, (n, d) in enumerate(candidates)]
    best = F.array_max(F.filter(F.array(*rows), lambda r: r.date.isNotNull() & (r.date.cast("string") != "")))
    return F.struct(best.date.alias("date"), best.label.alias("label"))


def recent_rows(rows: DataFrame, date_col: str, days: int = 3, limit: int = 8, tie: str = "id") -> DataFrame:
    """The first rows of the newest days that have any."""
    return newest_dates(rows, date_col, days).orderBy(F.col(date_col).desc(), tie).limit(limit)


def enriched(live: DataFrame, known: DataFrame, key: str, cols: list[str], default: str = "") -> DataFrame:
    """Live values where they aren't empty, else those of the table of known entities."""
    other = known.select(key, *[F.col(c).alias(f"known_{c}") for c in cols])
    joined = live.join(other, key, "left")
    return joined.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"known_{c}"), F.lit(default)) for c in cols}).drop(*[f"known_{c}" for c in cols])


def rss_entry(rows: DataFrame, base: str = "/") -> Column:
    """A feed's row as an item of RSS 2.0: its kind before the title, links that begin with ``/`` below ``base``, no date if
    it is none, a description if there is a summary. Null titles are empty."""
    from codexflow.functions.dates import feed_date, is_iso
    from codexflow.functions.text import escape_markup

    esc = lambda text: escape_markup(text, False)
    tag = lambda name, text, more="": F.concat(F.lit(f"<{name}{more}>"), text, F.lit(f"</{name}>"))
    link, title = F.coalesce("link", F.lit("")), F.concat(F.lit("["), kind_label(F.col("kind")), F.lit("] "), F.coalesce("title", F.lit("")))
    day = F.when(is_iso(F.col("date")), F.try_to_date("date"))
    summary = F.col("summary") if "summary" in rows.columns else F.lit(None).cast("string")
    parts = [
        tag("title", esc(title)), tag("link", esc(F.when(F.startswith(link, F.lit("/")), F.concat(F.lit(base.rstrip("/") + "/#"), link)).otherwise(link))),
        tag("guid", esc(F.concat_ws(":", "kind", F.coalesce("date", F.lit("")), link)), ' isPermaLink="false"'), tag("pubDate", feed_date(day)), tag("description", esc(summary)),
    ]
    return tag("item", F.concat_ws("", *parts))


def rss(items: DataFrame, title: str, link: str, description: str = "", base: str = "/") -> DataFrame:
    """One row, the feed as RSS 2.0, newest first; its day is that of the newest item. Items are a feed's top-k, so they are few."""
    from codexflow.functions.dates import feed_date, is_iso
    from codexflow.functions.text import escape_markup

    # Digits turned round sort the newest day first.
    late = F.translate("date", "0123456789", "9876543210")
    row = F.struct(late.alias("late"), "kind", "title", "link", rss_entry(items, base).alias("entry"))
    newest = F.max(F.when(is_iso(F.col("date")), F.try_to_date("date")))
    body = items.agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["entry"]), "").alias("body"), feed_date(newest).alias("day"))
    said = lambda name, text: F.concat(F.lit(f"<{name}>"), escape_markup(F.lit(text), False), F.lit(f"</{name}>"))
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel>'), said("title", title), said("description", description), said("link", link))
    built = F.coalesce(F.concat(F.lit("<lastBuildDate>"), "day", F.lit("</lastBuildDate>")), F.lit(""))
    return body.select(F.concat(head, built, "body", F.lit("</channel></rss>")).alias("value"))
