"""Intermediate tables in the shared folder, so that lost executors lose no work."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from haulage import storage
from haulage.session import scratch_dir, session_setting

#: Spark then deletes the shuffle files of a job when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python about ``BATCH_BYTES`` at a time, as a task's JVM and its worker both hold a batch."""
    with session_setting(spark, BATCH_SETTING, str(BATCH_BYTES)):
        yield


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table once below ``spark.checkpoint.dir`` and read it from there.

    The shuffles behind it are deleted: later reads use the files.
    """
    path = scratch_dir(df.sparkSession, label)
    with session_setting(df.sparkSession, CLEANUP, "true"), small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        for path in {x.rpartition("/")[0] for x in table.inputFiles()}:
            storage.remove(table.sparkSession, path)


def with_columns_of(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """The named columns of a table, cast to the given types; other columns go."""
    return df.select(*(df[name].cast(kind).alias(name) for name, kind in defaults.items()))
