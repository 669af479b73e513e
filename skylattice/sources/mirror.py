"""Checks of mirrored files, which stand in for downloads: the same generation, whole, and with the published checksum."""

from __future__ import annotations

from pyspark.sql import SparkSession


def status(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, time of change in seconds) of a file in any file system that Spark reaches; (-1, -1) where it isn't there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return -1, -1
    at = fs.getFileStatus(where)
    return at.getLen(), at.getModificationTime() // 1000


def md5(spark: SparkSession, path: str) -> str:
    """The MD5 of a file, streamed in the driver's JVM: the sum is sequential, so tasks can't share it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.md5Hex(stream)
    finally:
        stream.close()


def verify(spark: SparkSession, path: str, size: int, changed: int, checksum: str | None) -> str:
    """`missing`, `stale` (older than the published file, so no prefix of it), `partial`, `too long`, `corrupt`, or `ok`."""
    have, at = status(spark, path)
    if have < 0:
        return "missing"
    if at < changed:
        return "stale"
    if have != size:
        return "partial" if have < size else "too long"
    return "ok" if checksum is None or md5(spark, path) == checksum else "corrupt"
