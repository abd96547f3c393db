"""Writers. Each raises on failure and can be run again with the same result."""

from haulage.sinks.catalog import create_namespace, drop_table_load_date, replace_table
from haulage.sinks.files import (
    as_csv_text,
    compressed,
    dated_path,
    drop_load_date,
    open_writers,
    replace_load_dates,
    write_csv,
    write_parquet,
)
from haulage.sinks.quarantine import Quarantine, bad_rows, good_rows, write_apart
from haulage.sinks.jdbc import drop_tables, jdbc_catalog, load_table, swap_tables, write_table

__all__ = [
    "Quarantine",
    "as_csv_text",
    "bad_rows",
    "compressed",
    "create_namespace",
    "dated_path",
    "drop_load_date",
    "drop_table_load_date",
    "drop_tables",
    "good_rows",
    "jdbc_catalog",
    "load_table",
    "open_writers",
    "replace_load_dates",
    "replace_table",
    "swap_tables",
    "write_apart",
    "write_csv",
    "write_parquet",
    "write_table",
]
