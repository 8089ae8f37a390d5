"""History of bodies by their hashes, kept up by a stream that may be stopped at any time.

A body that its law hasn't had before becomes a revision. Which hashes a law has had is state of the query; what a batch adds is
written to a folder of its own number, which a batch that runs again overwrites, beside a row that says how the run went. So
the stored history has every revision once, whenever the query was stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RUN = "batch long, revisions long, entities long, newest string"


def new_revisions(stream: DataFrame, entity: str, day: str, body: str) -> DataFrame:
    """``entity``, ``revision_id`` (the first 12 digits), ``sha256`` and ``first_seen`` of bodies that are new to their entity.

    Within a batch the earliest day counts. A frame that doesn't stream gives the revisions of all its rows. Null bodies and null
    entities are left out.
    """
    named = stream.select(F.col(entity).alias("entity"), F.col(day).cast("string").alias("day"), F.col(body).alias("body")).filter("entity is not null and body is not null")
    hashed = named.select("entity", "day", F.sha2(F.col("body").cast("binary"), 256).alias("sha256"))
    if stream.isStreaming:

        def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
            seen = set(state.get[0]) if state.exists else set()
            found: dict[str, str | None] = {}
            for pdf in batches:
                for sha, at in zip(pdf["sha256"], pdf["day"]):
                    if sha not in seen:
                        found[sha] = at if sha not in found or (at is not None and (found[sha] is None or at < found[sha])) else found[sha]
            if found:
                state.update((sorted(seen | set(found)),))
            yield pd.DataFrame([(key[0], s, d) for s, d in sorted(found.items())], columns=["entity", "sha256", "first_seen"])

        kind = stream.schema[entity].dataType.simpleString()
        new = hashed.groupBy("entity").applyInPandasWithState(step, f"entity {kind}, sha256 string, first_seen string", "hashes array<string>", "append", GroupStateTimeout.NoTimeout)
    else:
        new = hashed.groupBy("entity", "sha256").agg(F.min("day").alias("first_seen"))
    return new.select(F.col("entity").alias(entity), F.left("sha256", F.lit(12)).alias("revision_id"), "sha256", "first_seen")


def commit(path: str, entity: str):
    """Writes a batch's revisions and its run row, the same files if the batch runs again."""

    def write(batch: DataFrame, number: int) -> None:
        folder = f"{path}/revisions/batch={number}"
        batch.write.mode("overwrite").parquet(folder)
        added = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        run = added.agg(F.count("*").alias("revisions"), F.count_distinct(entity).alias("entities"), F.max("first_seen").alias("newest"))
        run.select(F.lit(number).cast("long").alias("batch"), "revisions", "entities", "newest").write.mode("overwrite").parquet(f"{path}/runs/batch={number}")

    return write


def keep_history(stream: DataFrame, entity: str, day: str, body: str, path: str, checkpoint: str) -> StreamingQuery:
    """Takes in all that has landed and then stops; the same folders go on where the last run was."""
    new = new_revisions(stream, entity, day, body)
    return new.writeStream.foreachBatch(commit(path, entity)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/revisions").drop("batch")


def runs(spark: SparkSession, path: str) -> DataFrame:
    """One row a batch: its number, revisions, entities, and the newest day among them."""
    return spark.read.schema(RUN).parquet(f"{path}/runs")


def latest_run(spark: SparkSession, path: str) -> DataFrame:
    return runs(spark, path).orderBy(F.col("batch").desc()).limit(1)
