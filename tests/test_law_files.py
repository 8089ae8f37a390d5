"""Files of laws: current ids, versions, timelines, lines written and read back."""

import json

from pyspark.sql import functions as F

from codexflow.operators import law_files

BODY = "law string, revision string, position long, title string, articles array<struct<no: string, law: string>>"
META = "law string, revision string, position long, status string, amendment_type string, mission string"


def tables(spark, bodies, meta, enacted=()):
    return spark.createDataFrame(bodies, BODY), spark.createDataFrame(meta, META), spark.createDataFrame(list(enacted), "law string, date string")


def made(spark):
    bodies = [("A", "s1", 1, "one", [("1", "x"), ("2", "y")]), ("A", "s2", 2, "two", [("1", "z")]), ("B", "s3", 5, "b", None), ("B", "s4", 5, "later", []), (None, "s9", 1, "none", None), ("C", None, 1, "none", None)]
    meta = [("A", "v1", 1, "CurrentEnforced", "3", "New"), ("A", "v2", 2, None, "8", None), ("Z", "v7", 1, None, None, None), ("A", None, 9, "CurrentEnforced", "1", None)]
    return tables(spark, bodies, meta, [("A", "2031-01-02"), ("A", None), ("B", "2031-01-01")])


def test_current_ids(spark):
    bodies, meta, _ = made(spark)
    assert sorted(map(tuple, law_files.current_ids(bodies, meta).collect())) == [("A", "s2", "v1"), ("B", "s4", "s4")]


def test_versions_and_timeline(spark):
    bodies, meta, enacted = made(spark)
    ids = law_files.current_ids(bodies, meta)
    rows = law_files.versions(meta, bodies, ids).orderBy("law", "position", "revision").select("law", "revision", "path", "body_available").collect()
    assert [tuple(r) for r in rows] == [("A", "v1", "laws/A/revisions/v1.json", True), ("A", "v2", None, False), ("B", "s3", "laws/B/revisions/s3.json", True), ("B", "s4", "laws/B/revisions/s4.json", True)]
    events = law_files.timeline(meta, bodies, ids, enacted).orderBy("law", "part", "position", "event_id").select("event_id", "event_type", "status", "promulgation_date").collect()
    assert [tuple(r) for r in events] == [
        ("evt_A_enactment", "enactment", "Enacted", "2031-01-02"), ("evt_v1", "amendment", "CurrentEnforced", None), ("evt_v2", "repeal", "Unknown", None),
        ("evt_s3", "initial", "snapshot", None), ("evt_s4", "initial", "snapshot", None),
    ]


def test_files_written_and_read(spark, tmp_path):
    path = str(tmp_path / "files")
    law_files.write_files(law_files.file_lines(*made(spark), "articles", "no"), path)
    rows = law_files.read_files(spark.read.parquet(path), F.lit("A")).collect()
    assert [(r["path"].removeprefix("laws/A/"), r["part"]) for r in rows] == [
        ("articles/1.json", 0), ("current.json", 0), ("revisions/s1.json", 0), ("revisions/v1.json", 0), ("timeline.json", -1), ("timeline.json", 0), ("timeline.json", 1), ("timeline.json", 1),
        ("versions.json", -1), ("versions.json", 1), ("versions.json", 1),
    ]
    assert json.loads(rows[0]["line"]) == {"no": "1", "law": "z"}
    assert json.loads(rows[1]["line"]) == {"law": "A", "revision": "v1", "title": "two", "articles": [{"no": "1", "law": "z"}], "status": "current"}
    assert json.loads(rows[2]["line"])["status"] == "historical" and json.loads(rows[8]["line"]) == {"law": "A", "current_revision": "v1"}
    assert json.loads(rows[10]["line"])["path"] is None


def test_nothing(spark):
    assert law_files.file_lines(*tables(spark, [], []), "articles", "no").count() == 0


def test_a_large_law_is_written_by_several_tasks(spark, tmp_path):
    lines = spark.range(40_000).select(F.lit("A").alias("law"), F.lit("laws/A/timeline.json").alias("path"), F.lit(1).alias("part"), F.col("id").alias("position"), F.concat(*[F.md5(F.concat_ws(":", F.lit(i), "id").cast("binary")) for i in range(12)]).alias("line"))
    path = str(tmp_path / "large")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        law_files.write_files(lines, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() > 1
    assert [r["position"] for r in law_files.read_files(spark.read.parquet(path), F.lit("A")).collect()] == list(range(40_000))


def test_a_timeline_joins_once(spark):
    """Each further join of the revisions sorts them again in the same task."""
    bodies, meta, enacted = made(spark)
    plan = law_files.timeline(meta, bodies, law_files.current_ids(bodies, meta), enacted)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join " in line for line in plan.splitlines()) == 1, plan
