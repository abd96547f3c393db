"""CSV folder -> staging table in a catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from haulage.operators import assert_ready
from haulage.sinks import create_namespace, replace_table
from haulage.sources import CsvDialect, PLAIN, read_catalog_table, read_csv, read_csv_by_name, read_csv_folder, stage_inferred

# Fixed value: the data-file format asked of a catalog with several.
FILE_FORMAT = {"write.format.default": "parquet"}


def run(
    spark: SparkSession,
    folder: str,
    table: str,
    schema: T.StructType | str | None = None,
    properties: Mapping[str, str] | None = FILE_FORMAT,
    namespace_location: str | None = None,
    dialect: CsvDialect = PLAIN,
    keep_previous_files: bool = False,
    by_name: bool = False,
) -> DataFrame:
    """Replace ``table`` by the folder's CSV files; returns the table.

    Files must agree on their header, unless ``by_name`` matches their columns by name.
    Types that no ``schema`` gives are inferred while the text is staged, so the
    CSV is read once. ``properties`` can be emptied for catalogs that do not take them. Files of the
    version before are deleted after the switch unless ``keep_previous_files``.
    """
    if by_name:
        source = read_csv_by_name(spark, folder, schema, dialect)
    elif schema is None:
        source = read_csv(spark, f"{folder.rstrip('/')}/*.csv", dialect=dialect)
    else:
        source = read_csv_folder(spark, folder, schema, dialect)
    if schema is None:
        source = stage_inferred(source)
    source = assert_ready(source)
    create_namespace(spark, table.rpartition(".")[0], namespace_location)
    replace_table(source, table, properties, drop_previous_files=not keep_previous_files)
    return read_catalog_table(spark, table)
