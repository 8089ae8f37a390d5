"""Listings that go on by continuation: each page names the place of the next one.

``pages`` are landed pages, in any order, perhaps more than once: their listing, their place (``startRecord``, a page's number), the
place that follows (``nextRecordPosition``, or the next number where ``hasNextPage`` holds; null, or not beyond the page: the last) and
their items. A listing is what its first page leads to; pages that nothing leads to (of another run) are no part of it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from codexflow.sources.workspace import workspace


def next_record(body: Column) -> Column:
    """Place of the next page of a proceedings response."""
    return F.get_json_object(body, "$.nextRecordPosition").try_cast("long")


def next_page(number: Column, has_next: Column) -> Column:
    """Number of the next page where a notice response says that there is one."""
    return F.when(F.coalesce(has_next, F.lit(False)), number + 1)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reached(pages: DataFrame, listing: str, place: str, following: str, first: int = 1) -> DataFrame:
    """``listing`` and ``place`` of the pages that the first pages lead to.

    By pointer jumping: after k rounds the marks reach 2^k pages from the first, so a listing of n pages takes log n joins of
    two numbers a page, and no task walks a listing.
    """
    landed = pages.select(F.col(listing).alias("listing"), F.col(place).cast("long").alias("at"), F.col(following).cast("long").alias("to")).filter("listing is not null and at is not null").distinct()
    landed = _stored(landed, "landed")
    jumps = landed.filter("to > at").join(landed.select("listing", F.col("at").alias("to")).distinct(), ["listing", "to"], "left_semi").select("listing", "at", "to")
    # A page that landed twice with different successors leads to the nearer one.
    jumps = _stored(jumps.groupBy("listing", "at").agg(F.min("to").alias("to")), "jumps")
    marks = _stored(landed.filter(F.col("at") == first).select("listing", "at").distinct(), "marks")
    count = marks.count()
    while True:
        marks = _stored(marks.union(marks.join(jumps, ["listing", "at"]).select("listing", F.col("to").alias("at"))).distinct(), "marks")
        before, count = count, marks.count()
        if count == before:
            return marks.select(F.col("listing").alias(listing), F.col("at").alias(place))
        onward = jumps.select("listing", F.col("at").alias("to"), F.col("to").alias("beyond"))
        jumps = _stored(jumps.join(onward, ["listing", "to"]).select("listing", "at", F.col("beyond").alias("to")), "jumps")


def followed(pages: DataFrame, listing: str, place: str, following: str, items: str, first: int = 1) -> DataFrame:
    """``listing``, ``place`` and ``item`` of all items of the pages that are reached; of a page that landed twice one counts."""
    once = pages.dropDuplicates([listing, place])
    return once.join(reached(pages, listing, place, following, first), [listing, place]).select(listing, place, F.explode(items).alias("item"))


def lost_pages(pages: DataFrame, listing: str, place: str, following: str, first: int = 1) -> DataFrame:
    """``listing`` and ``place`` of pages that a reached one names and that haven't landed."""
    there = pages.join(reached(pages, listing, place, following, first), [listing, place], "left_semi")
    named = there.filter(F.col(following) > F.col(place)).select(listing, F.col(following).cast("long").alias(place)).distinct()
    return named.join(pages.select(listing, F.col(place).cast("long").alias(place)).distinct(), [listing, place], "left_anti")


#: Where a listing goes on, and the pages that have landed and wait for one before them (place: next place, items).
STATE = "expected long, ended boolean, waiting string"


def followed_stream(stream: DataFrame, listing: str, place: str, following: str, items: str, first: int = 1) -> DataFrame:
    """As ``followed`` for pages as they land: a page's items leave once all pages before it have come, each once.

    The offset of a listing is its state, kept by the checkpoint of the query, so a query that was stopped goes on
    where it was. Items are strings.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        expected, ended, waiting = state.get if state.exists else (first, False, "{}")
        held = {int(k): v for k, v in json.loads(waiting).items()}
        for pdf in batches:
            for at, to, said in zip(pdf["at"], pdf["to"], pdf["items"]):
                if not ended and at >= expected:
                    held.setdefault(int(at), [None if pd.isna(to) else int(to), list(said) if said is not None else []])
        out = []
        while not ended and expected in held:
            to, said = held.pop(expected)
            out += [(key[0], expected, x) for x in said]
            ended = to is None or to <= expected
            expected = expected if ended else to
        held = {} if ended else {k: v for k, v in held.items() if k > expected}
        state.update((expected, ended, json.dumps(held)))
        yield pd.DataFrame(out, columns=["listing", "at", "item"])

    narrow = stream.select(F.col(listing).alias("listing"), F.col(place).cast("long").alias("at"), F.col(following).cast("long").alias("to"), F.col(items).cast("array<string>").alias("items")).filter("listing is not null and at is not null")
    kind = stream.schema[listing].dataType.simpleString()
    found = narrow.groupBy("listing").applyInPandasWithState(step, f"listing {kind}, at long, item string", STATE, "append", GroupStateTimeout.NoTimeout)
    return found.select(F.col("listing").alias(listing), F.col("at").alias(place), "item")
