"""Version histories: as-of states, neighbours, current versions, keyed merges and structural diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def as_of(versions: DataFrame, dates: list[str], entity: str, key: Column, position: Column, date_col: str = "as_of") -> DataFrame:
    """Latest version of every entity at every date, null where none had begun.

    Equal keys keep the first in order. One aggregation serves all dates: each has a ``max_by`` of its
    own, combined before the shuffle, so rows aren't multiplied by the dates.
    """
    row, order = F.struct(*[F.col(f"`{c}`") for c in versions.columns]), F.struct(key, -position)
    states = [F.struct(F.lit(d).alias(date_col), F.max_by(F.when(key <= d, row), F.when(key <= d, order)).alias("version")) for d in dates]
    return versions.groupBy(entity).agg(F.array(*states).alias("states")).select(entity, F.inline("states"))


def neighbours(versions: DataFrame, entity: str, order: list[Column], carry: list[str]) -> DataFrame:
    """Every version with ``prev_*`` columns of the one before it; the first of an entity has nulls."""
    by = Window.partitionBy(entity).orderBy(*order)
    return versions.select("*", *[F.lag(c).over(by).alias(f"prev_{c}") for c in carry])


def current(versions: DataFrame, entity: str, order: Column) -> DataFrame:
    """The version that comes last by ``order`` (a struct with its tiebreaks)."""
    row = F.struct(*[F.col(f"`{c}`") for c in versions.columns])
    return versions.groupBy(entity).agg(F.max_by(row, order).alias("row_")).select("row_.*")


def current_by_status(versions: DataFrame, entity: str, order: Column, is_current: Column, value: str) -> DataFrame:
    """``value`` of the last version with the status of being in force, else of the last at all."""
    return versions.groupBy(entity).agg(F.coalesce(F.max_by(F.col(value), F.when(is_current, order)), F.max_by(F.col(value), order)).alias(value))


def merge_histories(low: DataFrame, high: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Union by key; rows of ``high`` win over ``low``, later ones over earlier; rows with a null key all stay."""
    both = low.withColumn("rank_", F.lit(0)).unionByName(high.withColumn("rank_", F.lit(1)), allowMissingColumns=True)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    row = F.struct(*[F.col(f"`{c}`") for c in both.columns if c != "rank_"])
    won = both.filter(known).groupBy(*keys).agg(F.max_by(row, F.struct("rank_", position)).alias("row_")).select("row_.*")
    return won.unionByName(both.filter(~known).drop("rank_"))


def _change(same: Column) -> Column:
    return F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(same, "unchanged").otherwise("modified")


def keyed_diff(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """``change`` (added, removed, modified, unchanged) of every key of either side, with both sides' values."""
    one = before.select(*keys, F.struct(*values).alias("old"))
    two = after.select(*keys, F.struct(*values).alias("new"))
    return one.join(two, keys, "full_outer").withColumn("change", _change(F.col("old").eqNullSafe(F.col("new"))))


def ordered_diff(before: DataFrame, after: DataFrame, keys: list[str], values: list[str], position: str, removed_last: bool = True) -> DataFrame:
    """Like ``keyed_diff``, but a row for every row of ``after``, and for every row of ``before`` whose key is
    in no row of ``after``; of a key that repeats on the other side the last by ``position`` is compared.

    ``part`` and ``place`` give the order: that of ``after``, then what was removed in that of ``before``; with
    ``removed_last`` false that of ``before``, then what was added.
    """
    row = F.struct(*values)
    last = lambda df, name: df.groupBy(*keys).agg(F.max_by(row, position).alias(name))
    one, two = (before, after) if removed_last else (after, before)
    old, new = ("old", "new") if removed_last else ("new", "old")
    kept = two.select(*keys, F.lit(0).alias("part"), F.col(position).alias("place"), row.alias(new)).join(last(one, old), keys, "left")
    gone = one.join(two.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit(1).alias("part"), F.col(position).alias("place"), row.alias(old))
    both = kept.unionByName(gone, allowMissingColumns=True)
    return both.select(*keys, "part", "place", "old", "new", _change(F.col("old").eqNullSafe(F.col("new"))).alias("change"))


def diff_summary(diff: DataFrame, by: list[str]) -> DataFrame:
    return diff.groupBy(*by).agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "modified", "unchanged")])


def paragraph_diff(before: DataFrame, after: DataFrame, article: str, number: str, position: str, text: str) -> DataFrame:
    """Paragraphs matched by number where both sides of an article number all of theirs, else by position.

    Every paragraph of ``after`` has a row, and every one of ``before`` without a partner; of a number that
    repeats on one side the last is the partner. By position, text and number must both agree to count as
    unchanged.
    """
    full = lambda df, name: df.groupBy(article).agg(F.bool_and(F.length(F.coalesce(F.col(number), F.lit(""))) > 0).alias(name))
    mode = full(before, "x").join(full(after, "y"), article, "full_outer").select(article, F.coalesce(F.col("x") & F.col("y"), F.lit(False)).alias("numbered"))
    key = F.when(F.col("numbered"), F.col(number)).otherwise(F.concat(F.lit("#"), F.col(position).cast("string")))
    side = lambda df: df.join(mode, article).select(article, "numbered", key.alias("key"), F.col(position).alias("position"), F.col(number).alias("number"), F.col(text).alias("text"))
    both = ordered_diff(side(before), side(after), [article, "numbered", "key"], ["number", "text"], "position")
    same = F.when(F.col("numbered"), F.col("old.text").eqNullSafe(F.col("new.text"))).otherwise(F.col("old").eqNullSafe(F.col("new")))
    return both.drop("part", "place").withColumn("change", _change(same))


def default_pair(versions: DataFrame, entity: str, day: Column, signature: Column, position: str, today: str, reach: int = 15) -> DataFrame:
    """Of every entity the latest version up to ``today`` and, walking back ``reach`` places at most,
    the nearest one before it whose signature differs; failing that the one just before."""
    known = versions.select(entity, F.col(position).alias("p"), day.alias("day"), signature.alias("signature"))
    late = known.filter(F.col("day") <= today).groupBy(entity).agg(F.max_by(F.struct("p", "signature"), F.struct("day", "p")).alias("b"))
    met = late.join(known, entity).filter((F.col("p") < F.col("b.p")) & (F.col("p") >= F.col("b.p") - reach))
    a = met.groupBy(entity).agg(F.coalesce(F.max(F.when(F.col("signature") != F.col("b.signature"), F.col("p"))), F.max("p")).alias("a"))
    return late.select(entity, F.col("b.p").alias("b")).join(a, entity, "left")


def shrunk(found: Column, baseline: Column, least: int = 100) -> Column:
    """Whether a corpus has lost over half of what was known of it; small baselines don't count."""
    return (baseline >= least) & (found * 2 < baseline)


def unseen(batch: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch that the cache doesn't hold, one for each key."""
    return batch.dropDuplicates(keys).join(cache.select(*keys).distinct(), keys, "left_anti")
