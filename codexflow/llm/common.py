"""Helpers that the corpus operators share: shipping code, shared storage, Arrow loops."""

from __future__ import annotations

import pickle
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches are cut into runs of about this many text bytes, which bounds a task's arrays.
RUN_BYTES = 4 << 20


def worker_state(name: str, make: Callable[[], object]) -> object:
    """A value kept in the Python worker between tasks (a vocabulary, a bounded word cache).

    One value at a time: workers live on from one operator to the next, and what the last one kept
    would count against the next one's memory.
    """
    home = sys.modules.setdefault("_codexflow_worker", types.ModuleType("_codexflow_worker")).__dict__
    if home.get("name") != name:
        home["value"] = None
        home["value"], home["name"] = make(), name
    return home["value"]


def shipped(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast ``value`` with the code of its class, so that workers need no installed package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast) -> object:
    """What ``shipped`` has sent; for use inside a task."""
    return pickle.loads(shared.value)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared storage, named by ``spark.checkpoint.dir``.

    Where that setting is absent, the context's own checkpoint folder is used. On a local master, which
    shares all folders with its tasks, one in the warehouse is set if there is none; a cluster has to name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            context.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
        root = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as Parquet into shared storage and read it back (by ``spark``, else by the session of
    ``df``), which cuts its lineage."""
    spark = spark or df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or a longer name if ``df`` has a column of that name already."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_remainder(col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the text ``null``."""
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("null")).cast("binary")) % modulus).cast("int")


def text_bytes(column: pa.Array) -> list[bytes]:
    """Values of a string or binary Arrow column as bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary() if column.type in (pa.string(), pa.binary()) else pa.large_binary()).to_pylist()]


def runs(batch: pa.RecordBatch, column: str, limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes in ``column``, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop
