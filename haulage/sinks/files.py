"""CSV, Parquet and JSON writers for any path Spark can open (``s3a://`` too)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulage import storage
from haulage.functions.dates import as_date_text
from haulage.operators.checks import Fingerprint, observed_metrics, observed_write
from haulage.session import session_setting
from haulage.sources.files import CsvDialect, MICROSECONDS, PLAIN, encoded

# Partition values one task writes side by side before Spark sorts the rest.
OPEN_FILES_PER_TASK = 16

#: Compressed JSON is read by one task a file; so a file holds no more records than this.
COMPRESSED_RECORDS = 500_000


def open_writers(spark: SparkSession):
    """Context in which partitioned writes keep one file open per value.

    Spark otherwise sorts every task's rows by the partition column first,
    even when a task holds a single value.
    """
    return session_setting(
        spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES_PER_TASK)
    )


def dated_path(base: str, name: str, run_date: dt.date | str) -> str:
    """``<base>/<name>_<YYYY-MM-DD>``."""
    return f"{base.rstrip('/')}/{name}_{as_date_text(run_date)}"


def as_csv_text(df: DataFrame) -> DataFrame:
    """Every column as the text the CSV writer gives it."""
    return df.select([_csv_text(field) for field in df.schema.fields])


def write_csv(
    df: DataFrame,
    path: str,
    dialect: CsvDialect = PLAIN,
    checksum: bool = False,
) -> Fingerprint:
    """Replace ``path`` by CSV with a header; returns what was written.

    The checksum is that of the text, so it can be compared with the file read
    back as strings. If the write fails, the old files stay.
    """
    text = as_csv_text(df) if checksum else df
    with storage.replacing(df.sparkSession, path) as (new,):
        return observed_write(
            text, lambda out: encoded(out, dialect).write.options(**dialect.writing()).csv(new), checksum
        )


def write_parquet(df: DataFrame, path: str, checksum: bool = False) -> Fingerprint:
    """Replace ``path`` by Parquet; returns what was written.

    If the write fails, the old files stay.
    """
    with storage.replacing(df.sparkSession, path) as (new,):
        return observed_write(df, lambda out: out.write.parquet(new), checksum)


def replace_load_dates(
    df: DataFrame,
    path: str,
    date_column: str = "load_date",
    dates: Iterable[str] = (),
    rebalance: bool = False,
    compression: str | None = None,
) -> Fingerprint:
    """Write JSON Lines under ``path/<date_column>=<value>/``.

    Each date in the data replaces its folder; all other dates stay. The new
    files are complete before any old folder is swapped out, so a failed job
    changes nothing. A date listed in ``dates`` for which there are no rows is
    emptied, so that a rerun that finds nothing leaves nothing stale behind.

    A run for one date needs no shuffle and no sort. For many dates set
    ``rebalance``: AQE then gathers each date into files of even size, and
    divides a date that holds a large part of the rows among several tasks.

    ``compression`` (``gzip``) writes files of a tenth of the size or so, which every reader
    of JSON Lines takes as they are.
    """
    spark = df.sparkSession
    dates = list(dates)
    source = df.hint("rebalance", date_column) if rebalance else df

    def write(out: DataFrame) -> None:
        (
            out.write.mode("overwrite")
            .options(partitionOverwriteMode="dynamic", ignoreNullFields="false", **MICROSECONDS)
            .options(**compressed(compression))
            .partitionBy(date_column)
            .json(path)
        )

    per_date = [F.count_if(F.col(date_column) == date).alias(date) for date in dates]
    with open_writers(spark):
        metrics = observed_metrics(source, write, [F.count(F.lit(1)).alias("rows"), *per_date])
    for date in dates:
        if metrics[date] == 0:
            drop_load_date(spark, path, date, date_column)
    return Fingerprint(metrics["rows"])


def compressed(codec: str | None, records: int = COMPRESSED_RECORDS) -> dict[str, str]:
    """Options of a text or JSON writer whose files are compressed, ``records`` in each at most."""
    if codec is None:
        return {}
    return {"compression": codec, "maxRecordsPerFile": str(records), "zlib.compress.level": "BEST_SPEED"}


def drop_load_date(
    spark: SparkSession,
    path: str,
    date: str,
    date_column: str = "load_date",
) -> bool:
    """Delete one date of a dated folder; False when it was not there."""
    return storage.remove(spark, f"{path.rstrip('/')}/{date_column}={date}")


def _csv_text(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    elif isinstance(field.dataType, T.TimestampNTZType):
        col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    else:
        col = col.cast("string")
    return col.alias(field.name)
