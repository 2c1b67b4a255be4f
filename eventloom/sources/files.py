"""Folders of whatever file system Spark writes to."""

from __future__ import annotations

import uuid
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, system = _system(spark, path)
    return system.exists(folder)


def drop_folder(spark: SparkSession, path: str) -> None:
    folder, system = _system(spark, path)
    system.delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder."""
    folder, system = _system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(folder)]


def read_file(spark: SparkSession, path: str) -> str:
    """Text of a small file."""
    file, system = _system(spark, path)
    stream = system.open(file)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_new_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet, whole or not at all; False if it exists.

    The text goes to a file of its own first, which is then renamed.
    """
    jvm = spark.sparkContext._jvm
    file, system = _system(spark, path)
    aside, _ = _system(spark, f"{path}.{uuid.uuid4().hex}.new")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(file.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        # Without the overwrite option a rename onto an existing file fails.
        context.rename(system.makeQualified(aside), system.makeQualified(file), spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as problem:
        system.delete(aside, False)
        if "FileAlreadyExistsException" in str(problem.java_exception):
            return False
        raise
    return True


def set_modified(spark: SparkSession, path: str, when: datetime) -> None:
    """Modification time of the files of a folder, as a copy of other files would keep it."""
    folder, system = _system(spark, path)
    for status in system.listStatus(folder):
        system.setTimes(status.getPath(), int(when.timestamp() * 1000), -1)
