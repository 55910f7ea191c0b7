"""Path checks and moves through Hadoop's file API, so they work on any store Spark can write to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _at(spark, source)
    _, to = _at(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(where, to):
        raise OSError(f"could not move {source} to {target}")


def drop(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def finished(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below path whose write has been committed."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    return [name for name in names if exists(spark, f"{path}/{name}/_SUCCESS")]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none if there is no such folder."""
    fs, where = _at(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    fs, where = _at(spark, path)
    stream = fs.create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, or of the first file of a folder that has any; None if it is compressed or there is none."""
    fs, where = _at(spark, path)
    statuses = sorted(fs.listStatus(where), key=lambda status: status.getPath().getName())
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    for status in statuses:
        name = status.getPath().getName()
        if name.startswith(("_", ".")) or not status.isFile() or not status.getLen():
            continue
        if codecs.getCodec(status.getPath()) is not None:
            return None
        stream = fs.open(status.getPath())
        try:
            reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return reader.readLine()
        finally:
            stream.close()
    return None
