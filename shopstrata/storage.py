"""Small file operations on whatever file system a path names, through Hadoop's API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, sorted; empty when it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def size_bytes(spark: SparkSession, *paths: str) -> int:
    total = 0
    for path in paths:
        fs, target = _open(spark, path)
        if fs.exists(target):
            total += fs.getContentSummary(target).getLength()
    return total


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _open(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line that is not blank, read from the start of the file only."""
    fs, target = _open(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(target)
    stream = fs.open(target)
    try:
        source = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line or ""
    finally:
        stream.close()


def publish(spark: SparkSession, staged: str, final: str) -> None:
    """Move a finished folder to its final name; the rename is the commit point."""
    fs, source = _open(spark, staged)
    _, target = _open(spark, final)
    if fs.exists(target):
        raise FileExistsError(f"{final} is already committed; is another writer running?")
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not move {staged} to {final}")


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
