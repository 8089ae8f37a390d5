"""Registration of queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """Tables of one scale, read when they are named."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with its oracle if there is one."""

    def add(work: Callable[[Tables], DataFrame]):
        QUERIES[work.__name__] = lambda spark, sf_dir: work(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[work.__name__] = sql
        return work

    return add
