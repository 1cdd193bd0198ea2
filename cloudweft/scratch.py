"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: While a table is written: Arrow batches of at most so many rows and bytes, so that very long values fill neither a
#: Python worker nor the buffers, and shuffle files that go with the job that made them.
_WHILE_WRITING = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: ``spark.checkpoint.dir``; a temporary one only in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_lock = threading.Lock()
_writers = 0
_before: dict[str, str | None] = {}


@contextlib.contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    """``_WHILE_WRITING``, and what the session had before once no thread writes any more."""
    global _writers
    with _lock:
        if not _writers:
            _before.update({k: spark.conf.get(k, None) for k in _WHILE_WRITING})
            for k, v in _WHILE_WRITING.items():
                spark.conf.set(k, v)
        _writers += 1
    try:
        yield
    finally:
        with _lock:
            _writers -= 1
            if not _writers:
                for k, v in _before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class _Tables(threading.local):
    """Paths of the tables that a thread has written, in order; None where one is gone."""

    def __init__(self) -> None:
        self.paths: list[str | None] = []


_own = _Tables()


def _place(spark: SparkSession, path: str) -> tuple:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: the lineage ends there and survives lost executors. What is not
    discarded goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cloudweft-{name}-{uuid.uuid4().hex}"
    _own.paths.append(path)
    target, files = _place(spark, path)
    files.deleteOnExit(target)
    with _settings(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cloudweft_path = path
    return out


def is_written(df: DataFrame) -> bool:
    return hasattr(df, "_cloudweft_path")


def tables() -> int:
    """A mark for ``discard``: how many tables this thread has written."""
    return len(_own.paths)


def discard(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Deletes the tables that this thread has written since the mark but those that are kept. Whatever is still to be
    computed may depend on kept tables only."""
    kept = {getattr(df, "_cloudweft_path", None) for df in keep}
    for k in range(since, len(_own.paths)):
        if (path := _own.paths[k]) is not None and path not in kept:
            target, files = _place(spark, path)
            files.delete(target, True)
            files.cancelDeleteOnExit(target)
            _own.paths[k] = None
