"""Files of any store the session can reach, by Spark's own Hadoop file system."""

from __future__ import annotations

import os
import uuid

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or a folder with all in it; False if there was none."""
    fs, where = _at(spark, path)
    return bool(fs.delete(where, True))


def list_paths(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of what lies directly in a folder, by name; none if it is missing."""
    fs, where = _at(spark, path)
    try:
        found = fs.listStatus(where)
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return []
        raise
    base = path.rstrip("/")
    return sorted((f"{base}/{s.getPath().getName()}", s.getModificationTime()) for s in found)


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of every data file below a folder, by path; Spark's own hidden files are left out."""
    fs, where = _at(spark, path)
    found, files = {}, fs.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found[f.getPath().toString()] = f.getLen()
    return found


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, where = _at(spark, path)
    return fs.getContentSummary(where).getLength()


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """The whole of a small file; None if it is missing."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    try:
        stream = fs.open(where)
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return None
        raise
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def overwrite(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file, whatever it held; a reader at that moment may see part of it."""
    fs, where = _at(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, content: bytes) -> bool:
    """Write a small file that must not exist yet; False, and nothing changed, if it does.

    The content is written under another name first and then given its name by a step that
    fails if the name is taken, so of several writers exactly one succeeds and readers see the
    whole file or none.  The step is a hard link on a local file system, else the store's
    rename without overwriting; a store whose rename is not atomic cannot hold such a file.
    """
    fs, where = _at(spark, path)
    folder, name = path.rsplit("/", 1)
    fs.mkdirs(where.getParent())
    spare = f"{folder}/.{name}.{uuid.uuid4().hex}"
    _fs, there = _at(spark, spare)
    stream = fs.create(there, False)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(fs.makeQualified(there).toUri().getPath(), fs.makeQualified(where).toUri().getPath())
            return True
        jvm = spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
        )
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(fs.makeQualified(there), fs.makeQualified(where), none)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if _is(e, "FileAlreadyExistsException"):
            return False
        raise
    finally:
        fs.delete(there, False)
