"""Written intermediate tables in the shared folder that the cluster names.

A staged table cuts the lineage and freezes values that a recomputed task could change (such as
the position of a row inside its partition), so the jobs that read it survive lost executors.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Spark then deletes the shuffle files of a statement as soon as the statement has ended.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Writer's options for tables that should take little room.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stellate-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


_lock = threading.Lock()
_writing: list[str | None] = []


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables written inside go with the write, not at some later garbage collection.

    The written table is all that later steps read. Writes may run at once; the last one puts the
    session's own value back.
    """
    with _lock:
        _writing.append(spark.conf.get(DROP_SHUFFLES, None) if not _writing else _writing[0])
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            before = _writing.pop()
            if not _writing:
                spark.conf.set(DROP_SHUFFLES, before) if before is not None else spark.conf.unset(DROP_SHUFFLES)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_runs: list[str] = []


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[str]:
    """A folder for all tables staged inside; deleted after success, kept after a failure.

    Only for jobs that have written what they return: staged tables cannot be read afterwards.
    """
    folder = f"{shared_folder(spark)}/staged/run-{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield folder
    finally:
        _runs.remove(folder)
    delete_folder(spark, folder)


def stage(df: DataFrame, label: str = "table", options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once, with the writer's ``options``, and return a reader of the written table."""
    spark = df.sparkSession
    folder = _runs[-1] if _runs else f"{shared_folder(spark)}/staged"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("error").options(**(options or {})).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.staged_at = path
    return written


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; other frames are passed over.

    Takes what ``stage`` or ``surrogate_key`` returned, after everything made from it is written.
    """
    for df in frames:
        if (path := vars(df).pop("staged_at", None)) is not None:
            delete_folder(df.sparkSession, path)
