"""Paths on the file system behind a URI, and a scratch folder all executors can see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    path, system = _path(spark, uri)
    return system.exists(path)


def files_in(spark: SparkSession, uri: str) -> list[str]:
    """Files directly under ``uri``; none when it does not exist."""
    path, system = _path(spark, uri)
    if not system.exists(path):
        return []
    return [str(status.getPath()) for status in system.listStatus(path) if status.isFile()]


def folders_in(spark: SparkSession, uri: str) -> list[str]:
    """Names of the folders directly under ``uri``; none when it does not exist."""
    path, system = _path(spark, uri)
    if not system.exists(path):
        return []
    return [status.getPath().getName() for status in system.listStatus(path) if status.isDirectory()]


def delete(spark: SparkSession, uri: str) -> None:
    """A file, or a folder with all in it."""
    path, system = _path(spark, uri)
    system.delete(path, True)


def read_text(spark: SparkSession, uri: str) -> str:
    path, system = _path(spark, uri)
    stream = system.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, uri: str, text: str) -> None:
    """A small file that appears whole; FileExistsError when there is one already."""
    path, system = _path(spark, uri)
    draft, _ = _path(spark, f"{uri.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(path) or not system.rename(draft, path):
        system.delete(draft, False)
        raise FileExistsError(uri)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder name under the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="candlewick-")
    return f"{base.rstrip('/')}/candlewick-{uuid.uuid4().hex}"
