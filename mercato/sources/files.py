"""Small file operations on whatever file system Spark writes to (Hadoop's)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, target = _at(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(target)) if fs.exists(target) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file."""
    fs, target = _at(spark, path)
    return fs.getFileStatus(target).getLen()


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, target = _at(spark, path)
    if not fs.rename(target, _at(spark, to)[1]):
        raise OSError(f"{path} was not moved to {to}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.mkdirs(target)


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; raises where there is one of that name."""
    fs, target = _at(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read(spark: SparkSession, path: str) -> str:
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
