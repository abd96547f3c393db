"""Reads that keep a bad row, as text, beside the good ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from haulage.schema import struct_of
from haulage.sources.files import CsvDialect, PLAIN, decoded

#: The text of a row that could not be read; null for a good row.
BAD_ROW = "_bad_row"
#: The file that a row came from.
FILE = "_file"


def _with_bad_row(schema: T.StructType | str) -> T.StructType:
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    taken = {BAD_ROW, FILE} & set(schema.fieldNames())
    if taken:
        raise ValueError(f"the schema has columns named {', '.join(sorted(taken))}")
    nullable = [T.StructField(f.name, f.dataType) for f in schema.fields]
    return T.StructType([*nullable, *struct_of(**{BAD_ROW: T.StringType()}).fields])


def read_csv_tolerant(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    dialect: CsvDialect = PLAIN,
    **options: str,
) -> DataFrame:
    """CSV with a schema; a row of other types or another number of values is kept as text.

    Adds the columns ``_bad_row`` and ``_file``. A header that is named or ordered differently
    still fails the job: every row would be wrong.
    """
    settings = {"enforceSchema": "false", **dialect.reading(), **options}
    settings |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW}
    read = spark.read.options(**settings).schema(_with_bad_row(schema)).csv(path if isinstance(path, str) else list(path))
    return _marked(decoded(read, dialect, keep=(BAD_ROW,)))


def read_json_tolerant(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """JSON with a schema; a line (or document) that is no such JSON is kept as text."""
    settings = {"multiLine": str(multi_line).lower(), **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW}
    read = spark.read.options(**settings).schema(_with_bad_row(schema)).json(path if isinstance(path, str) else list(path))
    return _marked(read)


def _marked(read: DataFrame) -> DataFrame:
    return read.withColumn(FILE, F.col("_metadata.file_path"))
