"""Laws put together from what is known of them: metadata, bodies and revisions, their indices and diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.operators import textdiff
from codexflow.operators.versions import neighbours


def known_ids(sources: list[DataFrame], col: str) -> DataFrame:
    """Ids that any source has, once each; null and empty ones are none."""
    out = sources[0].select(col)
    for other in sources[1:]:
        out = out.union(other.select(col))
    return out.filter(F.col(col).isNotNull() & (F.col(col).cast("string") != "")).distinct()


def with_bodies(meta: DataFrame, bodies: DataFrame, key: str, path: Column) -> DataFrame:
    """Metadata of versions with ``path`` where their body is there, else null."""
    there = bodies.select(F.col(key).alias("body_key_")).distinct()
    return meta.join(there, meta[key] == F.col("body_key_"), "left").withColumn("path", F.when(F.col("body_key_").isNotNull(), path)).drop("body_key_")


def assembled(revisions: DataFrame, dated: DataFrame, meta: DataFrame, law: str, revision: str) -> DataFrame:
    """Revisions of every law, with dates and metadata; those of the daily lists that the histories don't have
    are added. ``source`` says whether a revision is from a history or a daily list."""
    unseen = dated.join(revisions.select(law, revision), [law, revision], "left_anti").select(law, revision)
    both = revisions.select(law, revision, F.lit("history").alias("source")).union(unseen.dropDuplicates([law, revision]).withColumn("source", F.lit("daily")))
    once = dated.groupBy(law, revision).agg(*[F.min(c).alias(c) for c in dated.columns if c not in (law, revision)])
    return both.join(once, [law, revision], "left").join(meta, law, "left")


def with_revisions(laws: DataFrame, revisions: DataFrame, law: str) -> DataFrame:
    """Laws of which a revision is known; laws of metadata alone are left out."""
    return laws.join(revisions.select(law).distinct(), law, "left_semi")


def law_index(laws: DataFrame, revisions: DataFrame | None, law: str, title: str) -> DataFrame:
    """Index rows: path and API path of every law, and the number of its revisions (0 if no history is given)."""
    if revisions is None:
        counted = laws.withColumn("revisions_count", F.lit(0).cast("long"))
    else:
        n = revisions.groupBy(law).agg(F.count("*").alias("revisions_count"))
        counted = laws.join(n, law, "left").withColumn("revisions_count", F.coalesce("revisions_count", F.lit(0)).cast("long"))
    key = F.col(law).cast("string")
    return counted.select(law, title, "revisions_count", F.concat(F.lit("laws/"), key, F.lit("/current.json")).alias("path"), F.concat(F.lit("/laws/"), key).alias("href"))


def article_changes(articles: DataFrame, order: DataFrame, law: str, revision: str, article: str, value: str) -> DataFrame:
    """Changes of articles of every revision against the one before it; all of a law's first are added.

    ``articles`` has one row an article of a revision; ``order`` has ``law``, ``revision`` and ``prev``, the
    revision before (null: the first).
    """
    later = articles.select(law, revision, article, F.col(value).alias("new"))
    earlier = articles.select(law, F.col(revision).alias("prev"), article, F.col(value).alias("old"))
    mine = later.join(order, [law, revision])
    before = order.filter(F.col("prev").isNotNull()).join(earlier, [law, "prev"])
    met = mine.withColumn("in_new", F.lit(True)).join(before.select(law, revision, article, "old", F.lit(True).alias("in_old")), [law, revision, article], "full_outer")
    change = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(F.col("old").eqNullSafe(F.col("new")), "unchanged").otherwise("modified")
    return met.select(law, revision, article, "old", "new", change.alias("change")).filter("change <> 'unchanged'")


def revision_order(revisions: DataFrame, law: str, revision: str, order: list[Column]) -> DataFrame:
    return neighbours(revisions.select(law, revision, *[c.alias(f"o{i}_") for i, c in enumerate(order)]), law, [F.col(f"o{i}_") for i in range(len(order))], [revision]).select(law, revision, F.col(f"prev_{revision}").alias("prev"))


def pair_changes(articles: DataFrame, law: str, revision: str, article: str, value: str, pairs: DataFrame) -> DataFrame:
    """Changes between chosen revisions: ``pairs`` has ``law``, ``prev`` and ``revision``."""
    return article_changes(articles, pairs, law, revision, article, value)


def of_update(changes: DataFrame, law: str, revision: str, wanted: DataFrame) -> DataFrame:
    """Changes of the wanted updates; one of an unknown revision has none."""
    return changes.join(wanted.select(law, revision).distinct(), [law, revision], "left_semi")


def payloads(changes: DataFrame) -> DataFrame:
    """What is published of a change: the whole side if an article came or went, else both and the sizes of
    their common ends."""
    ends = textdiff.coarse_diff(F.col("old"), F.col("new"))
    side = lambda name, text: F.struct(F.lit(name).alias("side"), text.alias("text"))
    return changes.withColumns({
        "whole": F.when(F.col("change") == "added", side("to", F.col("new"))).when(F.col("change") == "removed", side("from", F.col("old"))),
        "ends": F.when(F.col("change") == "modified", ends),
    })


def missing_outputs(wanted: DataFrame, done: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    """What is left to do: wanted keys without an output, the first of them in order if a number is given."""
    left = wanted.select(*keys).distinct().join(done.select(*keys).distinct(), keys, "left_anti")
    return left if most is None else left.orderBy(*keys).limit(most)
