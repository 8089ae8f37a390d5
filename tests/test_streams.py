"""Streams that are stopped and begun again."""

import random

import pytest
from pyspark.errors import StreamingQueryException

from codexflow.sources import continued
from codexflow.streaming import history

PAGE = "listing string, at long, next long, items array<string>"


def walk(rows, first=1):
    """Items by listing, page after page."""
    out = []
    for listing in {r[0] for r in rows} - {None}:
        pages, at = {r[1]: r for r in rows if r[0] == listing and r[1] is not None}, first
        while at in pages:
            out += [(listing, at, x) for x in pages[at][3] or []]
            at = pages[at][2] if (pages[at][2] or 0) > at else None
    return out


@pytest.fixture(scope="module")
def landed():
    rng, rows = random.Random(8), []
    for k in range(25):
        at = 1
        for page in range(rng.randint(0, 20)):
            following = at + rng.randint(1, 100)
            rows.append((f"l{k}", at, following if page < 18 else rng.choice([None, -1, at]), [f"{k}-{at}-{i}" for i in range(rng.randint(0, 3))] or rng.choice([None, []])))
            at = following
        rows.append((f"l{k}", at + 1000, None, ["of another run"]))
    lost = [r for r in rows if rng.random() > 0.03 or r[0] == "l1"]
    return lost + [(None, 1, None, ["x"]), ("l1", None, None, ["x"])] + lost[:5]


def test_followed(spark, landed):
    pages = spark.createDataFrame(landed, PAGE).repartition(3)
    found = continued.followed(pages, "listing", "at", "next", "items").collect()
    assert sorted(map(tuple, found)) == sorted(walk(landed))
    there = {(r[0], r[1]) for r in landed}
    ends = {(r[0], r[2]) for r in landed if r[1] is not None and (r[2] or 0) > r[1] and (r[0], r[2]) not in there}
    lost = {tuple(r) for r in continued.lost_pages(pages, "listing", "at", "next").collect()}
    assert lost <= ends and all(not any(x[0] == k and x[1] >= at for x in walk(landed)) for k, at in lost)
    assert continued.followed(pages.limit(0), "listing", "at", "next", "items").count() == 0


def test_continuations(spark):
    df = spark.createDataFrame([('{"nextRecordPosition": 101}',), ('{"nextRecordPosition": null}',), ("{",)], "j string")
    assert [r[0] for r in df.select(continued.next_record(df["j"])).collect()] == [101, None, None]


def test_a_stopped_stream_goes_on(spark, landed, tmp_path):
    rows = landed[:]
    random.Random(9).shuffle(rows)
    cuts = [rows[:100], rows[100:101], rows[101:]]
    for k, part in enumerate(cuts):
        spark.createDataFrame(part, PAGE).coalesce(1).write.mode("append").parquet(str(tmp_path / "landed"))
        stream = spark.readStream.schema(PAGE).parquet(str(tmp_path / "landed"))
        found = continued.followed_stream(stream, "listing", "at", "next", "items")
        found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.schema("listing string, at long, item string").parquet(str(tmp_path / "out")).collect()
    assert sorted(map(tuple, kept)) == sorted(walk(landed))


def test_history_of_a_killed_stream(spark, tmp_path, monkeypatch):
    """The query dies after a batch was written and before it was committed; the history equals one batch over all."""
    rng = random.Random(10)
    rows = [(rng.choice(["a", "b", "c", None]), f"2024-01-{rng.randint(1, 28):02}", rng.choice(["x", "y", "z", "w", None])) for _ in range(120)]
    schema = "law string, day string, body string"
    path, state = str(tmp_path / "kept"), str(tmp_path / "state")
    rows.sort(key=lambda r: r[1])
    fail = {"at": 1}
    plain = history.commit

    def dying(path, entity):
        write = plain(path, entity)

        def once(batch, number):
            write(batch, number)
            if fail.pop("at", None) == number:
                raise RuntimeError("killed")

        return once

    monkeypatch.setattr(history, "commit", dying)
    keep = lambda: history.keep_history(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "landed")), "law", "day", "body", path, state)
    for k in range(3):
        spark.createDataFrame(rows[40 * k : 40 * k + 40], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "landed"))
        try:
            keep().awaitTermination()
        except StreamingQueryException:
            assert k == 1 and not fail
            keep().awaitTermination()
    stored = history.history(spark, path, "law string, revision_id string, sha256 string, first_seen string, batch int")
    whole = history.new_revisions(spark.createDataFrame(rows, schema), "law", "day", "body")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, whole.collect())) != []
    said = history.runs(spark, path).collect()
    assert sum(r["revisions"] for r in said) == stored.count() and len({r["batch"] for r in said}) == len(said) >= 3
    assert history.latest_run(spark, path).first()["batch"] == max(r["batch"] for r in said)
