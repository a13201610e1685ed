"""Directory names through the file system API, so any Hadoop path works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def named(spark: SparkSession, path: str, start: str) -> list[str]:
    """Names under a path that begin with ``start``."""
    folder, fs = _path(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return [name for name in names if name.startswith(start)]


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers N of the directories ``prefix=N`` under a path, ascending."""
    start = f"{prefix}="
    return sorted(int(name[len(start):]) for name in named(spark, path, start))


def first_text(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file or of a finished folder with one; None where there is none."""
    place, fs = _path(spark, path)
    if not fs.exists(place) or fs.getFileStatus(place).isDirectory() and not committed(spark, path):
        return None
    row = spark.read.text(path).first()
    return row and row[0]


def committed(spark: SparkSession, path: str) -> bool:
    """True once the job that wrote the directory has finished."""
    marker, fs = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def remove(spark: SparkSession, path: str) -> None:
    folder, fs = _path(spark, path)
    fs.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _path(spark, path)
    return fs.exists(place)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there whole or not at all; replaces an older one.

    It is written under a name that Spark's readers skip, then renamed.
    """
    place, fs = _path(spark, path)
    draft, _ = _path(spark, f"{place.getParent().toString()}/_{place.getName()}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(place, False)
    fs.rename(draft, place)
