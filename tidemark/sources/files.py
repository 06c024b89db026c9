"""Small files of a data mart, through the file system that Spark itself uses: listed, read, and created at most once."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _handle(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modified in milliseconds) of what lies directly in a folder, by name; an absent folder holds nothing."""
    fs, at = _handle(spark, path)
    if not fs.exists(at):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(at))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, at = _handle(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _handle(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text; False, and nothing changed, where there is one already.

    Of callers that meet, one gets True. On a local disk the finished file is
    linked to its name, which fails where the name is taken. Elsewhere the file
    system's own rename without overwriting is used, which is atomic on HDFS;
    on an object store it is as good as that store's connector makes it.
    """
    fs, at = _handle(spark, path)
    fs.mkdirs(at.getParent())
    hidden = f"{at.getParent().toString()}/.{uuid.uuid4().hex}"
    if fs.getScheme() == "file":
        target, made = (unquote(urlparse(p).path) for p in (fs.makeQualified(at).toString(), fs.makeQualified(
            spark._jvm.org.apache.hadoop.fs.Path(hidden)).toString()))
        with open(made, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(made, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(made)
        return True
    made = spark._jvm.org.apache.hadoop.fs.Path(hidden)
    stream = fs.create(made, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(made, at, options)
    except Exception as error:
        fs.delete(made, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _handle(spark, path)
    fs.delete(at, True)
