"""Path tests, deletes and replacements through Hadoop's file system, for any URI scheme."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False when there was nothing to delete."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.delete(hadoop_path, True)


def make_until_exit(spark: SparkSession, path: str) -> None:
    """Create a folder that is deleted when the driver's JVM ends."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)


def first_lines(spark: SparkSession, pattern: str, at_once: int = 32) -> list[tuple[str, str | None]]:
    """(path, first line) of the files that match; None for an empty file.

    As with a listing, the driver opens the files itself, several at a time.
    """
    fs, hadoop_path = _resolve(spark, pattern)
    found = fs.globStatus(hadoop_path)
    paths = sorted(f.getPath().toString() for f in found or [] if f.isFile() and not f.getPath().getName().startswith(("_", ".")))

    def first(path: str) -> tuple[str, str | None]:
        stream = fs.open(_resolve(spark, path)[1])
        try:
            reader = spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
            return path, spark._jvm.java.io.BufferedReader(reader).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(first, paths))


@contextmanager
def replacing(spark: SparkSession, *paths: str) -> Iterator[list[str]]:
    """Where to write what shall replace the folders ``paths``.

    A path that exists gets a hidden folder beside it, swapped in when the block
    ends well; all paths change together. If the block fails, what it wrote is
    deleted and the old folders stay. The swap renames folders: there is a moment
    without the folder, and a store without renames copies the files.
    """
    staged = [_beside(path) if exists(spark, path) else path for path in paths]
    try:
        yield staged
        old = _swap_in(spark, [(a, b) for a, b in zip(staged, paths) if a != b])
    except BaseException:
        for path in staged:
            remove(spark, path)
        raise
    for path in old:
        remove(spark, path)


def _beside(path: str) -> str:
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{name}-{uuid.uuid4().hex}"


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _resolve(spark, source)
    if not fs.rename(source_path, _resolve(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def _swap_in(spark: SparkSession, pairs: list[tuple[str, str]]) -> list[str]:
    """Put each new folder in place; returns where the old ones are now."""
    moved: list[tuple[str, str]] = []
    try:
        for new, path in pairs:
            old = _beside(path)
            _rename(spark, path, old)
            moved.append((old, path))
            _rename(spark, new, path)
    except BaseException:
        for old, path in reversed(moved):
            remove(spark, path)
            _rename(spark, old, path)
        raise
    return [old for old, _ in moved]
