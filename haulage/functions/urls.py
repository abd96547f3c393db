"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from haulage.functions.text import last_segment

SCHEME_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def has_scheme(url: str | Column) -> Column:
    """True when the URL starts with a scheme; false for null."""
    column = F.col(url) if isinstance(url, str) else url
    return F.coalesce(column.rlike(SCHEME_PATTERN), F.lit(False))


def target_name(url: str | Column) -> Column:
    """File name a URL is stored under: the text after its last ``/``.

    A query string stays part of the name. A URL ending in ``/`` names no
    file and gives null.
    """
    return F.nullif(last_segment(url), F.lit(""))
