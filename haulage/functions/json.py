"""JSON text in a column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_field(column: str | Column, path: str) -> Column:
    """The value at ``path`` (``$.a.b``) as text; null when absent or malformed."""
    return F.get_json_object(column, path)


def json_text(column: str | Column) -> Column:
    """A struct, array or map as JSON text, null fields written out."""
    return F.to_json(column, {"ignoreNullFields": "false"})
