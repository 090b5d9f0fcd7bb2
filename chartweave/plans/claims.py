"""Small files that only one of several writers can create.

A claim is a file whose name says what is claimed. It appears under its name with its whole text at once, or not at
all: it is written under a hidden name and then linked (local and mounted folders) or renamed (other file systems,
where a rename onto an existing file fails). Object stores without such a rename need a folder elsewhere for claims.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _is_local(files) -> bool:
    return files.getUri().getScheme() == "file"


def publish(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create the file unless it is there; True for the one writer whose text it holds."""
    target, files = _open(spark, path)
    files.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    if _is_local(files):
        hidden, visible = draft.toUri().getPath(), target.toUri().getPath()
        with open(hidden, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(hidden, visible)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(hidden)
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if files.rename(draft, target):
            return True
    except (Py4JJavaError, PySparkException):
        if not files.exists(target):
            raise
    files.delete(draft, False)
    return False


def make_folder(spark: SparkSession, folder: str) -> None:
    target, files = _open(spark, folder)
    files.mkdirs(target)


def names(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names in a folder with their age in seconds; empty if there is no such folder."""
    target, files = _open(spark, folder)
    if not files.exists(target):
        return {}
    now = time.time()
    found = ((s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(target))
    return {name: now - changed / 1000 for name, changed in found if not name.startswith((".", "_"))}


def text_of(spark: SparkSession, path: str) -> str:
    target, files = _open(spark, path)
    if _is_local(files):
        with open(target.toUri().getPath(), encoding="utf-8") as stream:
            return stream.read()
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    target, files = _open(spark, path)
    files.delete(target, True)
