"""Small files and folders of a shared store, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return bool(store.exists(where))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if it does not exist."""
    store, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    store, where = _at(spark, path)
    store.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    store, where = _at(spark, path)
    stream = store.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: it appears under its name, in place of an older one, when it
    is complete."""
    store, where = _at(spark, path)
    part = where.suffix(".part")
    stream = store.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    store.delete(where, False)
    if not store.rename(part, where):
        raise OSError(f"could not write {path}")
