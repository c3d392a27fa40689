"""What the operators share on the Spark side: the shared folder, cut lineage, bucket counts, packed rows."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Releases the shuffle files of a finished step, so that one step's files are on disk at a time.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the folder that the cluster shares (``spark.checkpoint.dir``) and read from there."""
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new frame takes the setting up
    finally:
        spark.conf.set(_CLEANUP, before)


def fitted(df: DataFrame, rows_per_task: int = 100_000) -> tuple[DataFrame, int]:
    """A cut table in as many partitions as its rows need, and the number of rows.

    Few rows then take few tasks, and a table of one partition is joined and grouped without an exchange.
    """
    n = df.count()
    return df.coalesce(max(1, -(-n // rows_per_task))), n


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where none is set, on a single machine only, a new temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="docmart-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def kept(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The same rows as a Parquet table in the shared folder, which goes when the application ends; in one folder for each value of ``by``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    drop_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder, which is made if it is not there, when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place)  # only what is there can be marked
    store.deleteOnExit(place)


def pack(key: np.ndarray, bits: int, columns: Iterable[np.ndarray], kind: int = 0) -> Iterator[tuple[int, int, bytes]]:
    """Rows (bucket, kind, blob): the columns of all items whose key has the same leading bits, one after another."""
    if not len(key):
        return
    bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    columns = [c[order] for c in columns]
    for a, b in zip(at, [*at[1:], len(bucket)], strict=True):
        yield int(bucket[a]), kind, b"".join(c[a:b].tobytes() for c in columns)


def unpack(blobs: list[bytes] | list[np.ndarray], types: list[np.dtype]) -> list[np.ndarray]:
    """The columns of packed rows, joined."""
    parts: list[list[np.ndarray]] = [[] for _ in types]
    width = sum(np.dtype(t).itemsize for t in types)
    for blob in blobs:
        n, at = len(blob) // width, 0
        for k, t in enumerate(types):
            parts[k].append(np.frombuffer(blob, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(p) if p else np.empty(0, t) for p, t in zip(parts, types, strict=True)]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ids_of(column: pa.Array) -> np.ndarray:
    """A numpy array of integer ids without nulls."""
    return column.cast(pa.int64()).to_numpy(zero_copy_only=False)
