"""Streams over what has landed, stopped and begun again, against one batch over all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.plans.base import Tables, query
from codexflow.sources import continued
from codexflow.sources.workspace import workspace
from codexflow.streaming import history

#: Conversations as listings: turns are pages, from 0; a text whose length seven divides is a last page.
_PAGES = "(select conv_id, turn, text, length(text) % 7 > 0 as more, row_number() over (partition by conv_id order by turn) - 1 as n from conversations)"
_FOLLOWED = f"select conv_id, turn, md5(text) as item_md5 from {_PAGES} p where n = turn and not exists (select 1 from {_PAGES} q where q.conv_id = p.conv_id and q.turn < p.turn and not q.more)"


def _pages(t: Tables) -> DataFrame:
    more = F.length("text") % 7 > 0
    return t.conversations.select("conv_id", "turn", continued.next_page(F.col("turn"), more).alias("next"), F.array("text").alias("items"))


def _landed(rows: DataFrame, name: str, first: str) -> tuple[str, str]:
    """Folders of two landings: the rows that ``first`` holds for, and the others."""
    base = workspace(rows.sparkSession, name)
    rows.filter(first).write.parquet(f"{base}/landed/part=1")
    return base, f"not ({first})"


@query(_FOLLOWED)
def listing_followed(t: Tables) -> DataFrame:
    """Items of listings whose pages name the next one, in one batch."""
    found = continued.followed(_pages(t), "conv_id", "turn", "next", "items", first=0)
    return found.select("conv_id", "turn", F.md5(F.col("item").cast("binary")).alias("item_md5"))


@query(_FOLLOWED)
def listing_streamed(t: Tables) -> DataFrame:
    """The same by a stream: the later halves of the listings land first, the others after the stream has been stopped."""
    pages = _pages(t)
    base, rest = _landed(pages, "listing", "turn >= 4")
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in pages.schema.fields)}, part int"

    def run() -> None:
        stream = t.spark.readStream.schema(schema).parquet(f"{base}/landed")
        found = continued.followed_stream(stream, "conv_id", "turn", "next", "items", first=0)
        found.writeStream.format("parquet").option("path", f"{base}/items").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    run()
    pages.filter(rest).write.parquet(f"{base}/landed/part=2")
    run()
    found = t.spark.read.schema("conv_id long, turn long, item string").parquet(f"{base}/items")
    return found.select("conv_id", "turn", F.md5(F.col("item").cast("binary")).alias("item_md5"))


@query("select conv_id, sha256(role) as sha256, left(sha256(role), 12) as revision_id, min(turn)::varchar as first_seen from conversations group by conv_id, role")
def history_streamed(t: Tables) -> DataFrame:
    """Revisions (roles that are new to their conversation) as a stream has stored them over two runs."""
    rows = t.conversations.select("conv_id", F.col("turn").cast("string").alias("turn"), "role")
    base, rest = _landed(rows, "history", "turn < 3")
    schema, kept = "conv_id long, turn string, role string, part int", "conv_id long, revision_id string, sha256 string, first_seen string, batch int"
    keep = lambda: history.keep_history(t.spark.readStream.schema(schema).parquet(f"{base}/landed"), "conv_id", "turn", "role", f"{base}/kept", f"{base}/checkpoint").awaitTermination()
    keep()
    rows.filter(rest).write.parquet(f"{base}/landed/part=2")
    keep()
    return history.history(t.spark, f"{base}/kept", kept).select("conv_id", "sha256", "revision_id", "first_seen")
