"""What a build publishes and keeps: documents of laws, indices, schemas, packed metadata, run states, views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How many folders the documents of laws are dealt to.
BUCKETS = 64


def write_documents(rows: DataFrame, key: str, path: str, buckets: int = BUCKETS) -> None:
    """One line of JSON a law, in folders by a hash of its id, compressed; a law's place follows from its id."""
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    # Ranges, so that a folder is written by as many tasks as it has data for.
    bucketed.repartitionByRange("bucket", key).write.mode("overwrite").option("compression", "gzip").partitionBy("bucket").json(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType, key: str, wanted: Column, buckets: int = BUCKETS) -> DataFrame:
    """The document of one law: only its folder is read."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).json(path).filter((F.col("bucket") == F.pmod(F.xxhash64(wanted), F.lit(buckets)).cast("int")) & (F.col(key) == wanted)).drop("bucket")


def write_archive(rows: DataFrame, path: str, order: list[str]) -> None:
    """History rows as Parquet under zstandard, sorted so that equal values stand together."""
    rows.sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").parquet(path)


def index_document(rows: DataFrame, name: str, order: list[Column], generated: Column) -> DataFrame:
    """An index as one document: the number of rows, when it was made, and the rows, one line each in ``order``.

    Head and rows are lines of one file set (``part`` 0 and 1), so no task holds the whole list.
    """
    head = rows.agg(F.count("*").alias("n")).select(F.lit(0).alias("part"), F.to_json(F.struct(F.lit(name).alias("name"), F.col("n").alias("count"), generated.alias("generated_at"))).alias("line"))
    body = rows.orderBy(*order).select(F.lit(1).alias("part"), F.to_json(F.struct(*rows.columns)).alias("line"))
    return head.unionByName(body)


def latest_document(rows: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest date alone."""
    newest = rows.agg(F.max(date_col).alias("newest_"))
    return rows.join(F.broadcast(newest), F.col(date_col) == F.col("newest_")).drop("newest_")


def schema_text(rows: DataFrame) -> str:
    """Schema of a table as JSON, to be published beside it."""
    return rows.schema.json()


def faults(lines: DataFrame, line_col: str, schema: T.StructType, required: list[str]) -> DataFrame:
    """Lines of JSON that don't fit a schema, with ``fault``: ``unreadable``, or the first required field that is missing."""
    read = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = lines.withColumn("read_", F.from_json(line_col, read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    fault = F.when(F.col("read_").isNull() | F.col("read_._corrupt_record").isNotNull(), F.lit("unreadable"))
    for name in required:
        fault = fault.when(F.col(f"read_.{name}").isNull(), F.lit(name))
    return parsed.withColumn("fault", fault).filter("fault is not null").drop("read_")


def packed(rows: DataFrame, key: str) -> DataFrame:
    """Metadata as lines of JSON; ``key`` is a field of each line."""
    return rows.select(F.to_json(F.struct(key, *[c for c in rows.columns if c != key])).alias("value"))


def unpacked(lines: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """The key and, as a struct without it, what each line holds; unreadable lines and lines without a key are left out."""
    read = lines.select(F.from_json("value", schema).alias("r")).filter(F.col(f"r.{key}").isNotNull())
    return read.select(F.col(f"r.{key}").alias(key), F.struct(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields if f.name != key]).alias("meta"))


def swap_into(spark: SparkSession, built: str, published: str) -> bool:
    """Put a built folder in the place of the published one. What was there comes back if that fails."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    new, old, aside = path(built), path(published), path(published.rstrip("/") + ".old")
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(new):
        return False
    system.delete(aside, True)
    had = system.exists(old)
    if had and not system.rename(old, aside):
        return False
    if system.rename(new, old):
        system.delete(aside, True)
        return True
    if had:
        system.rename(aside, old)
    return False


def run_state(results: DataFrame, source: str, failed: Column, day: str) -> DataFrame:
    """State of every source after a run: the numbers of items and failures, ``ok``, ``partial`` or ``failed``, and
    the last day without a failure."""
    counted = results.groupBy(source).agg(F.count("*").alias("items"), F.count_if(failed).alias("failures"), F.max(F.when(~failed, F.col(day))).alias("last_success"))
    status = F.when(F.col("failures") == 0, "ok").when(F.col("failures") < F.col("items"), "partial").otherwise("failed")
    return counted.withColumn("status", status)


def merged_state(before: DataFrame, run: DataFrame, source: str) -> DataFrame:
    """States with those of a run in their place; a failed run keeps the last success of the one before."""
    both = run.join(before.select(source, F.col("last_success").alias("earlier_")), source, "left")
    kept = both.withColumn("last_success", F.coalesce("last_success", "earlier_")).drop("earlier_")
    return kept.unionByName(before.join(run.select(source), source, "left_anti"))


def catalog(spark: SparkSession, root: str, schemas: dict[str, str], prefix: str = "") -> list[str]:
    """A temporary view for every table below ``root``; one that isn't there is an empty view of its schema, so
    that a search over all of them goes on. Returns the names of those that are there."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    there = []
    for name, schema in schemas.items():
        place = path(f"{root}/{name}.parquet")
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            spark.read.parquet(f"{root}/{name}.parquet").createOrReplaceTempView(prefix + name)
            there.append(name)
        else:
            spark.createDataFrame([], schema).createOrReplaceTempView(prefix + name)
    return there
