"""Small files and folders on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _at(spark, old)
    if not fs.rename(p, _at(spark, new)[0]):
        raise OSError(f"{old} can't be renamed to {new}")


def beside(spark: SparkSession, path: str, mark: str) -> str:
    """A path in the same folder that readers of the folder pass over."""
    p, _ = _at(spark, path)
    return f"{p.getParent().toString()}/_{p.getName()}.{mark}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
