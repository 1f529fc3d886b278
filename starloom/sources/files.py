"""Folders of tables, through the file system that their paths name (local, HDFS, object store)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below ``path``."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """(name, size, time) of a file or of the files in a folder: changes when they are rewritten."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return ()
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the Parquet files anywhere below ``path``, relative to it."""
    p, fs = _path(spark, path)
    top, found, listed = fs.makeQualified(p).toString().rstrip("/"), [], fs.listFiles(p, True)
    while listed.hasNext():
        name = listed.next().getPath().toString()
        if name.endswith(".parquet") and not any(part.startswith(("_", ".")) for part in name[len(top) + 1:].split("/")):
            found.append(name[len(top) + 1:])
    return sorted(found)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A new file with ``text``, there whole or not at all; raises FileExistsError if the path is taken."""
    jvm = spark._jvm
    target, fs = _path(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if fs.exists(target):
            raise FileExistsError(path) from error
        raise
