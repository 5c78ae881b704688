"""Small calls to the Hadoop file system that Spark itself uses.

Only metadata passes through here (names, sizes, one-line pointer files);
table contents are always read and written by Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.delete(target, True)


def make_until_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that is removed, with its contents, when the JVM ends."""
    fs, target = _handle(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)


def bytes_below(spark: SparkSession, path: str) -> int:
    fs, target = _handle(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """``(full path, is directory)`` of the direct children, by path."""
    fs, target = _handle(spark, path)
    if not fs.exists(target):
        return []
    return sorted((s.getPath().toString(), s.isDirectory()) for s in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _handle(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder last changed, in epoch seconds."""
    fs, target = _handle(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def _write(fs, target, text: str, overwrite: bool) -> None:
    stream = fs.create(target, overwrite)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, whatever was there."""
    fs, target = _handle(spark, path)
    _write(fs, target, text, True)


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it appears whole, and only if no other writer was first.

    The writer that makes the claim beside it may publish; claims are made by
    exclusive creation, so of several writers exactly one goes on.
    """
    fs, target = _handle(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    jvm = spark.sparkContext._jvm
    claim, draft = (jvm.org.apache.hadoop.fs.Path(f"{path}.{end}") for end in ("claim", "draft"))
    try:
        _write(fs, claim, "", False)
    except Exception as error:
        if fs.exists(claim) or fs.exists(target):
            raise FileExistsError(path) from error
        raise
    try:
        if fs.exists(target):
            raise FileExistsError(path)
        _write(fs, draft, text, True)
        if not fs.rename(draft, target):
            raise FileExistsError(path)
    finally:
        fs.delete(claim, False)
