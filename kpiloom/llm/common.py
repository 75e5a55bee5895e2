"""Helpers that the training-data operators share: tables, shared folders, Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import kpiloom


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that their Python finds it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(kpiloom.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="kpiloom-code-")) / "kpiloom_code.zip"  # on the driver, whose file server hands it out
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a session without that setting on a local master gets a scratch folder
    of its own; a cluster without the setting is refused, as a folder of one
    machine is not visible to the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="kpiloom-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later jobs read it, whichever executors are lost."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SLICE_BYTES = 8 << 20  # of a batch that a function gets at once, or one longer row


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about SLICE_BYTES."""
    rows = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
    for begin in range(0, batch.num_rows, rows):
        yield batch.slice(begin, rows)


def release() -> None:
    """Give freed memory back, as Python workers wait for their next task with what they hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not this C library


def in_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType) -> DataFrame:
    """Apply ``function`` to the rows of ``df``, some at a time; results of None are left out."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in slices(batch):
                    if (out := function(part)) is not None:
                        yield out
                    del part, out
                del batch
        finally:
            release()

    return df.mapInArrow(each, schema)


def utf8_parts(column: pa.Array, most: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The strings of an Arrow column as bytes, some whole rows at a time.

    Yields (first row, end row, bytes, offsets into them) with about ``most``
    bytes; a longer text comes alone and whole. Nulls are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + most, "right")) - 1)
        yield row, end, raw[starts[row]:starts[end]], starts[row:end + 1] - starts[row]
        row = end
