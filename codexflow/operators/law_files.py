"""The files of a law: its current text, articles, revisions, versions and timeline, as lines that a writer deals out.

Inputs are tables of bodies and of metadata; ids and positions are what the caller names so:

* ``bodies``: ``law``, ``revision``, ``position`` and the fields of the text; laws without any body have no files;
* ``meta``: ``law``, ``revision``, ``position``, ``status``, ``amendment_type`` and further fields, one row a known revision;
* ``enacted``: ``law`` and ``date``, the day a law was promulgated.

Defined results: a null ``revision`` or ``law`` is no revision; rows that repeat one all stay in the lists;
of equal positions the greater id is the later; a law without metadata is listed by its bodies; null articles are none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.operators.versions import current_by_status
from codexflow.operators.views import EVENTS
from codexflow.sources.workspace import stored

#: The status of a revision in force, the kind of an event without a known amendment, the status of an enactment.
IN_FORCE, SNAPSHOT, ENACTED, UNKNOWN = "CurrentEnforced", "snapshot", "Enacted", "Unknown"


def _known(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("law").isNotNull() & F.col("revision").isNotNull())


def current_ids(bodies: DataFrame, meta: DataFrame) -> DataFrame:
    """``law``, ``body_revision`` (its last body) and ``current_revision``, the id that body is published by: that of the
    last metadata in force, else of the last metadata, else its own."""
    last = _known(bodies).groupBy("law").agg(F.max_by("revision", F.struct("position", "revision")).alias("body_revision"))
    named = current_by_status(_known(meta), "law", F.struct("position", "revision"), F.col("status") == IN_FORCE, "revision")
    return last.join(named, "law", "left").select("law", "body_revision", F.coalesce("revision", "body_revision").alias("current_revision"))


def published(bodies: DataFrame, ids: DataFrame) -> DataFrame:
    """Bodies by the ids they are published by, with ``status`` current or historical."""
    named = _known(bodies).join(ids, "law")
    revision = F.when(F.col("revision") == F.col("body_revision"), F.col("current_revision")).otherwise(F.col("revision"))
    return named.withColumn("revision", revision).withColumn("status", F.when(F.col("revision") == F.col("current_revision"), "current").otherwise("historical")).drop("body_revision", "current_revision")


def revision_path(law: Column, revision: Column) -> Column:
    return F.concat(F.lit("laws/"), law.cast("string"), F.lit("/revisions/"), revision.cast("string"), F.lit(".json"))


def versions(meta: DataFrame, bodies: DataFrame, ids: DataFrame) -> DataFrame:
    """Versions of the laws that have files: the metadata with ``path`` (null without a body) and ``body_available``;
    of laws without metadata the bodies themselves."""
    there = published(bodies, ids)
    known = _known(meta)
    path = revision_path(F.col("law"), F.col("revision"))
    held = there.select("law", "revision", F.lit(True).alias("held_")).distinct()
    listed = known.join(ids.select("law"), "law", "left_semi").join(held, ["law", "revision"], "left")
    listed = listed.withColumn("path", F.when(F.col("held_"), path)).withColumn("body_available", F.coalesce("held_", F.lit(False))).drop("held_")
    alone = there.join(known.select("law").distinct(), "law", "left_anti").drop("status").withColumn("path", path).withColumn("body_available", F.lit(True))
    return listed.unionByName(alone, allowMissingColumns=True)


def timeline(meta: DataFrame, bodies: DataFrame, ids: DataFrame, enacted: DataFrame) -> DataFrame:
    """Events of the laws that have files, in the order of ``part`` and ``position``: the enactment where its day is
    known, then a revision each; of laws without metadata their bodies, the first of which is the initial one.

    What is asked of a law is one row, stored, so the revisions are sorted once for one join. ``ids`` are those of
    ``current_ids``: a law without metadata publishes its bodies by their own ids, so no body is looked up.
    """
    known, held = _known(meta), _known(bodies)
    said = [
        known.select("law", F.lit(True).alias("meta_")), held.select("law", F.col("position").alias("first_")), ids.select("law", F.lit(True).alias("files_")),
        enacted.filter("date is not null").select("law", F.col("date").alias("promulgation_date")),
    ]
    about = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), said).groupBy("law").agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("meta_", "files_")], *[F.min(c).alias(c) for c in ("first_", "promulgation_date")])
    about = stored(about.filter("files_").drop("files_"), "laws")
    kind = F.lit(SNAPSHOT)
    for value, name in EVENTS.items():
        kind = F.when(F.col("amendment_type") == value, name).otherwise(kind)
    event_id = F.concat(F.lit("evt_"), F.col("revision").cast("string"))
    amended = known.withColumns({"part": F.lit(1), "event_id": event_id, "event_type": kind, "status": F.coalesce("status", F.lit(UNKNOWN)), "of_meta_": F.lit(True)}).drop("amendment_type")
    alone = held.withColumns({"part": F.lit(1), "event_id": event_id, "event_type": F.lit(SNAPSHOT), "status": F.lit(SNAPSHOT), "of_meta_": F.lit(False)})
    rows = amended.unionByName(alone, allowMissingColumns=True).join(about.drop("promulgation_date"), "law").filter(F.col("of_meta_") == F.col("meta_"))
    rows = rows.withColumn("event_type", F.when(~F.col("of_meta_") & (F.col("position") == F.col("first_")), "initial").otherwise(F.col("event_type"))).drop("of_meta_", "meta_", "first_")
    first = about.filter(F.col("meta_") & F.col("promulgation_date").isNotNull())
    first = first.select("law", F.lit(0).alias("part"), F.concat(F.lit("evt_"), F.col("law").cast("string"), F.lit("_enactment")).alias("event_id"), F.lit("enactment").alias("event_type"), F.lit(ENACTED).alias("status"), "promulgation_date")
    return rows.unionByName(first, allowMissingColumns=True)


def _lines(rows: DataFrame, path: Column, part: Column, order: Column, line: Column) -> DataFrame:
    return rows.select("law", path.alias("path"), part.alias("part"), order.cast("long").alias("position"), line.alias("line"))


def _json(*fields: str) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def file_lines(bodies: DataFrame, meta: DataFrame, enacted: DataFrame, articles: str, article_id: str) -> DataFrame:
    """Lines of all files: ``law``, ``path``, ``part``, ``position`` and ``line``, JSON with its nulls.

    A current text, an article of it or a revision is one line; versions and timeline have a head (``part`` -1) and a line
    an entry, so a law with very many revisions is no single row. ``articles`` names the bodies' array of articles.
    """
    ids = current_ids(bodies, meta)
    texts = published(bodies, ids)
    folder = F.concat(F.lit("laws/"), F.col("law").cast("string"), F.lit("/"))
    under = lambda *name: F.concat(folder, *[F.lit(n) if isinstance(n, str) else n for n in name])
    text = _json(*[c for c in texts.columns if c != "position"])
    now = _known(bodies).join(ids, "law").filter(F.col("revision") == F.col("body_revision")).withColumn("revision", F.col("current_revision")).withColumn("status", F.lit("current"))
    each = now.select("law", F.explode(articles).alias("article"))
    listed, events = versions(meta, bodies, ids), timeline(meta, bodies, ids, enacted)
    entry = lambda rows, *left: _json(*[c for c in rows.columns if c not in ("law", "position", articles, *left)])
    zero, head, position = F.lit(0), F.lit(-1), F.col("position")
    parts = [
        _lines(now, under("current.json"), zero, zero, text),
        _lines(each, under("articles/", F.col("article")[article_id].cast("string"), ".json"), zero, zero, F.to_json("article", {"ignoreNullFields": "false"})),
        _lines(texts, revision_path(F.col("law"), F.col("revision")), zero, zero, text),
        _lines(ids, under("versions.json"), head, zero, _json("law", "current_revision")),
        _lines(listed, under("versions.json"), F.lit(1), position, entry(listed)),
        _lines(ids, under("timeline.json"), head, zero, _json("law")),
        _lines(events, under("timeline.json"), F.col("part"), position, entry(events, "part")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_files(lines: DataFrame, path: str, buckets: int = 64) -> None:
    """The lines in folders by a hash of the law, in order. Ranges of the whole order are dealt out, so a law
    with a third of all lines is written by several tasks."""
    order = ["law", "path", "part", "position"]
    bucketed = lines.withColumn("bucket", F.pmod(F.xxhash64("law"), F.lit(buckets)).cast("int"))
    bucketed.repartitionByRange("bucket", *order).sortWithinPartitions("bucket", *order).write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(path)


def read_files(lines: DataFrame, law: Column, buckets: int = 64) -> DataFrame:
    """The lines of one law from written ones: only its folder is read."""
    return lines.filter((F.col("bucket") == F.pmod(F.xxhash64(law), F.lit(buckets)).cast("int")) & (F.col("law") == law)).orderBy("path", "part", "position").drop("bucket")
