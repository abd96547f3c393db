"""Required values, enforced by the expression that carries them.

The check is part of the value, not a filter beside it: Spark is free to move
and merge filters and to drop null rows ahead of them, but it cannot use a
value without computing it. So whatever reads a required value also checks it,
in the same pass. One missing value fails the task, the job aborts before it
commits, and the old output stays in place.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, functions as F


def missing_names(required: Mapping[str, Column]) -> Column:
    """Comma-separated names of the columns that are null; ``''`` if none is."""
    return F.concat_ws(
        ", ", *[F.when(col.isNull(), F.lit(name)) for name, col in required.items()]
    )


def require(value: Column, required: Mapping[str, Column], what: str) -> Column:
    """``value``, or an error naming the required columns that are null."""
    absent = reduce(lambda a, b: a | b, [col.isNull() for col in required.values()])
    message = F.concat(F.lit(f"{what}: missing required keys: "), missing_names(required))
    return F.when(absent, F.raise_error(message)).otherwise(value)
