"""Small file-system steps on whatever system a path names: metadata and short
texts only, no data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below ``path``, by name; none if it isn't there."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A short text file that appears whole or not at all: it is written under
    another name and renamed."""
    fs, p = _at(spark, path)
    _, ready = _at(spark, f"{path}.part")
    out = fs.create(ready, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(ready, p):
        raise OSError(f"could not rename to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
