"""First rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

DEFAULT_ROWS = 20


def preview(
    df: DataFrame,
    rows: int = DEFAULT_ROWS,
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """``rows`` rows; which ones is open unless ``order_by`` is given.

    Without an order Spark stops reading as soon as it has enough rows. With
    one, each task keeps its own best rows and only those are merged.
    """
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(rows)
