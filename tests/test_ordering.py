"""Total order by ranges."""

import random

from pyspark.sql import functions as F

from codexflow.operators import ordering, views


def test_places_and_sums(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "2024-01-01", *[f"2023-{m:02}-01" for m in range(1, 13)]]), rng.choice([None, 1, 5])) for i in range(3000)]
    table = spark.createDataFrame(rows, "id int, day string, n int").repartition(5)
    found = ordering.total_order(table, [F.col("day").asc_nulls_last(), F.col("id").desc()], "at", {"before": "n"}).collect()
    wanted = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", -r[0]))
    total, sums = 0, []
    for r in wanted:
        sums.append(total)
        total += r[2] or 0
    assert sorted(((r["at"], r["id"], r["before"]) for r in found)) == [(k, r[0], s) for k, (r, s) in enumerate(zip(wanted, sums))]
    assert ordering.total_order(table.limit(0), [F.col("id")], "at").count() == 0


def test_a_hot_date_is_dealt_out(spark, monkeypatch):
    """One date has half the rows: no range has twice as many as the median one."""
    paths, make = [], ordering.workspace
    monkeypatch.setattr(ordering, "workspace", lambda s, n: paths.append(make(s, n)) or paths[-1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit("2024-06-01")).otherwise(F.concat(F.lit("2023-01-"), F.col("id") % 28)).alias("day"))
        found = views.placed(rows, F.col("day"), [F.col("id")]).agg(F.min("place"), F.max("place"), F.count_distinct("place")).first()
        assert tuple(found) == (1, 40_000, 40_000)
        sizes = sorted(r["count"] for r in spark.read.parquet(paths[-1]).groupBy(F.shiftright("number_", 33)).count().collect())
        assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
