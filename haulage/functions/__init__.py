"""Column expressions. All are built-in Spark expressions; none is a UDF."""

from haulage.functions.codes import map_code
from haulage.functions.dates import as_date_text, load_date_key, season_of
from haulage.functions.json import json_field, json_text
from haulage.functions.nulls import falsy_to_null
from haulage.functions.required import missing_names, require
from haulage.functions.text import concat_strict, join_text, last_segment
from haulage.functions.urls import has_scheme, target_name

__all__ = [
    "as_date_text",
    "concat_strict",
    "falsy_to_null",
    "has_scheme",
    "join_text",
    "json_field",
    "json_text",
    "last_segment",
    "load_date_key",
    "map_code",
    "missing_names",
    "require",
    "season_of",
    "target_name",
]
