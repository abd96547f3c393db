"""Readers. Each returns a lazy DataFrame."""

from haulage.sources.catalog import query_catalog, read_catalog_table
from haulage.sources.files import (
    CsvDialect,
    LOSSLESS,
    PLAIN,
    landed_by_date,
    landed_files,
    read_csv,
    read_csv_by_name,
    read_csv_folder,
    read_json_documents,
    read_load_dates,
    read_parquet,
)
from haulage.sources.inferred import read_csv_inferred, stage_inferred
from haulage.sources.jdbc import (
    Bounds,
    Endpoint,
    Split,
    count_rows,
    find_tables,
    read_query,
    read_table,
)
from haulage.sources.tolerant import read_csv_tolerant, read_json_tolerant

__all__ = [
    "Bounds",
    "CsvDialect",
    "Endpoint",
    "LOSSLESS",
    "PLAIN",
    "Split",
    "count_rows",
    "find_tables",
    "landed_by_date",
    "landed_files",
    "query_catalog",
    "read_catalog_table",
    "read_csv",
    "read_csv_by_name",
    "read_csv_folder",
    "read_csv_inferred",
    "read_csv_tolerant",
    "read_json_documents",
    "read_json_tolerant",
    "read_load_dates",
    "read_parquet",
    "read_query",
    "read_table",
    "stage_inferred",
]
