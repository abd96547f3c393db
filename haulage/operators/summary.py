"""Whole-table and per-name results.

Every aggregate here combines inside the map tasks first, so a name that holds
a large part of all rows sends one row per task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """The number of rows as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, column: str | Column, name: str = "names") -> DataFrame:
    """Exact number of distinct non-null values.

    Distinct values are found per task, then per key, before they are counted.
    """
    return df.agg(F.count_distinct(column).alias(name))


def last_write_wins(
    df: DataFrame,
    key: str | Column,
    order: str | Column,
    values: dict[str, str | Column],
    name: str = "name",
) -> DataFrame:
    """Per key, the values of the row that comes last in ``order``.

    ``order`` must tell the rows of one key apart. The values travel as one
    struct, so they always come from the same row. Unlike a window with
    ``row_number``, this never brings all rows of a key into one task.
    """
    key = F.col(key) if isinstance(key, str) else key
    packed = F.struct(
        *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in values.items()]
    )
    latest = df.groupBy(key.alias(name)).agg(F.max_by(packed, order).alias("__last"))
    return latest.select(name, *[F.col(f"__last.`{k}`").alias(k) for k in values])
