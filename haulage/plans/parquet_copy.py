"""CSV -> Parquet, checked by reading it back."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

from haulage import storage
from haulage.operators import verify
from haulage.session import scratch_dir
from haulage.sinks import Quarantine, good_rows, write_apart, write_parquet
from haulage.sources import CsvDialect, PLAIN, read_csv, read_csv_inferred, read_csv_tolerant, read_parquet


def run(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: T.StructType | str | None = None,
    dialect: CsvDialect = PLAIN,
) -> DataFrame:
    """Convert a CSV; returns the checked Parquet table.

    Without ``schema`` the types are inferred while the text is staged in the shared folder, so
    the CSV is read once either way. An older table at ``parquet_path`` is replaced once
    the copy is checked.
    """
    staged = scratch_dir(spark, "staged-csv")
    try:
        if schema is None:
            source = read_csv_inferred(spark, csv_path, dialect, staged)
        else:
            source = read_csv(spark, csv_path, schema, dialect=dialect)
        with storage.replacing(spark, parquet_path) as (new,):
            written = write_parquet(source, new, checksum=True)
            verify(written, read_parquet(spark, new), parquet_path)
    finally:
        storage.remove(spark, staged)
    return read_parquet(spark, parquet_path)


def run_tolerant(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: T.StructType | str,
    required: Iterable[str] = (),
    max_bad_share: float = 0.01,
    dialect: CsvDialect = PLAIN,
) -> tuple[DataFrame, Quarantine]:
    """Convert a CSV that may hold bad rows; returns the good rows and both counts.

    Good and bad rows are written below ``parquet_path`` in one pass (see
    :func:`haulage.sinks.write_apart`); too many bad rows fail the job.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    read = read_csv_tolerant(spark, csv_path, schema, dialect)
    counts = write_apart(read, parquet_path, required, max_bad_share)
    return good_rows(spark, parquet_path, schema), counts
