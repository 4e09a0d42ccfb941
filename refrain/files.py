"""Small steps on any file system that Spark can reach, made by the driver."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with the time of their last change in milliseconds, by the
    clock of the file system; nothing if there is no folder."""
    if not exists(spark, path):
        return {}
    found = _system(spark, path).listStatus(_path(spark, path))
    return {f.getPath().getName(): f.getModificationTime() for f in found}


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    _system(spark, path).delete(_path(spark, path), True)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, or return False if there is one of that name.

    The file is written under a passing name and renamed without overwriting, which
    file systems such as HDFS do in one step. A store without such a rename needs a
    committer or lock of its own.
    """
    jvm = spark._jvm
    draft = f"{path.rpartition('/')[0]}/.draft-{uuid.uuid4().hex}"
    stream = _system(spark, draft).create(_path(spark, draft), False)
    stream.write(bytearray(text.encode()))
    stream.close()
    conf = spark._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), conf)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context.rename(_path(spark, draft), _path(spark, path), options)
    except Py4JJavaError as fault:
        remove(spark, draft)
        if "FileAlreadyExists" in fault.java_exception.getClass().getName():
            return False
        raise
    return True
