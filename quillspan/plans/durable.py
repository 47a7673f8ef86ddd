"""Cutting lineage in storage every executor can read."""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scratch: dict[str, str] = {}
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch one only for local sessions."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = tempfile.mkdtemp(prefix="quillspan-")
    return _scratch[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the result has no lineage to lose.

    The shuffles of the written plan have no other reader, so their files go with it and not at some later collection.
    """
    folder, conf = new_folder(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        conf.set(_CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    _folders[out] = folder
    return out


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder by the file system that its path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(*frames: DataFrame) -> None:
    """Delete the folders of results of :func:`materialize` that nothing unwritten is derived from any more."""
    for frame in frames:
        folder = _folders.pop(frame, None)
        if folder is not None:
            delete_folder(frame.sparkSession, folder)
