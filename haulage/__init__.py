"""Batch ETL on Spark: read, clean, reshape, land and check tables.

Sub-packages
------------
functions   column expressions
operators   DataFrame -> DataFrame steps and data checks
sources     readers (CSV, Parquet, JSON documents, JDBC, catalog tables)
sinks       writers (dated files, JDBC staging tables, catalog tables)
plans       whole pipelines built from the above
"""

__version__ = "0.1.0"
