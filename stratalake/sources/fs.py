"""The few file-system steps Spark has no DataFrame call for, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, str, int]]:
    """(path, name, size) of the plain files matching, sorted by path; names and sizes only."""
    fs, p = _open(spark, pattern)
    found = fs.globStatus(p) or []
    files = [(s.getPath().toString(), s.getPath().getName(), s.getLen()) for s in found if s.isFile()]
    return sorted(files)


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of everything matching, folders included, sorted."""
    fs, p = _open(spark, pattern)
    return sorted(s.getPath().getName() for s in (fs.globStatus(p) or []))


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _open(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"Cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _open(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
