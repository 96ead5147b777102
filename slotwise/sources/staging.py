"""Tables written to a folder that every executor can read.

Staging computes a frame once, cuts its lineage and keeps it through the loss
of executors, which a cached frame does not.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which must be set."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        raise RuntimeError(f"{SETTING} must name a folder that all executors share")
    return folder.rstrip("/")


def run_folder(spark: SparkSession, work: str | None = None) -> str:
    """A name that no other run uses, under ``work`` or the session's shared folder."""
    return f"{work or shared_folder(spark)}/slotwise-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a frame as Parquet and return a scan of what was written."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` has come to its end."""
    location, files = file_system(spark, f"{folder}/_SUCCESS")
    return files.exists(location)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """The folders in a folder, none if there is no such folder."""
    location, files = file_system(spark, folder)
    if not files.exists(location):
        return []
    return sorted(found.getPath().toString() for found in files.listStatus(location) if found.isDirectory())


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, if there is one."""
    (old, files), (new, _) = file_system(spark, source), file_system(spark, target)
    files.delete(new, True)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    (location, files), (draft, _) = file_system(spark, path), file_system(spark, f"{path}-{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    files.delete(location, False)
    if not files.rename(draft, location):
        raise OSError(f"cannot write {path}")


def read_note(spark: SparkSession, path: str) -> str | None:
    """What ``write_note`` has written; None if it has not."""
    location, files = file_system(spark, path)
    if not files.exists(location):
        return None
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_marks(spark: SparkSession, paths: Iterable[str]) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of files."""
    found = []
    for path in sorted(paths):
        location, files = file_system(spark, path)
        status = files.getFileStatus(location)
        found.append((path, status.getLen(), status.getModificationTime()))
    return found


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of staged tables."""
    location, files = file_system(spark, folder)
    files.delete(location, True)
