"""Places and running sums in one order over a whole table, without a task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexflow.sources.workspace import workspace

#: A row's number is its partition's in the upper bits and its place there in the lower 33.
_BITS = 33


def total_order(df: DataFrame, keys: list[Column], place: str, sums: dict[str, str | Column] | None = None) -> DataFrame:
    """``df`` with ``place``, its rank (0, 1, ...) in the order of ``keys``, and for each of ``sums`` the sum of
    that column over all rows before it (0 at the first; nulls add nothing).

    Rows are dealt out by ranges of the keys and sorted there; each range is counted, and the counts before it, one
    row a range, are added to the places inside. Keys that tie stay in one range, so a key that many rows share needs a
    further one that tells them apart; equal rows get different places. The ranges are stored, as they are read twice.
    """
    sums = sums or {}
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("number_", F.monotonically_increasing_id())
    path = workspace(df.sparkSession, "order")
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    ranged = ranged.withColumn("range_", F.shiftright("number_", _BITS))
    totals = ranged.groupBy("range_").agg(F.count("*").alias("rows_"), *[F.sum(c).alias(f"{n}_total_") for n, c in sums.items()])
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = totals.select("range_", F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("rows_"), *[F.coalesce(F.sum(f"{n}_total_").over(before), F.lit(0)).alias(f"{n}_total_") for n in sums])
    placed = ranged.join(F.broadcast(offsets), "range_")
    inside = Window.partitionBy("range_").orderBy("number_").rowsBetween(Window.unboundedPreceding, -1)
    at = (F.col("number_").bitwiseAND(F.lit((1 << _BITS) - 1)) + F.col("rows_")).alias(place)
    running = [(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"{n}_total_")).alias(n) for n, c in sums.items()]
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], at, *running)
