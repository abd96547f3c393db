"""Carry a run's rows into a stored table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F


def merge_latest(stored: DataFrame, new: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The rows of both, by key; where both have one, the new row as a whole.

    Each side has a key once (a run's own repetitions are settled first, see
    :func:`haulage.operators.last_write_wins`). Null keys are equal. The result has the columns
    of ``new``; a column that ``stored`` lacks is null in its rows.
    """
    keys = list(keys)
    others = [name for name in new.columns if name not in keys]
    kept = [F.col(f"`{n}`") if n in stored.columns else F.lit(None).cast(new.schema[n].dataType).alias(n) for n in others]
    old = stored.select(*[F.col(f"`{k}`").alias(f"__old{i}") for i, k in enumerate(keys)], F.struct(F.lit(True), *kept).alias("__old"))
    late = new.select(*[f"`{k}`" for k in keys], F.struct(F.lit(True), *[f"`{n}`" for n in others]).alias("__new"))
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__old{i}")) for i, k in enumerate(keys)]
    joined = late.join(old, same, "full_outer")
    is_new = F.col("__new").isNotNull()

    def pick(name: str, i: int | None = None):
        if i is not None:
            return F.when(is_new, F.col(f"`{name}`")).otherwise(F.col(f"__old{i}")).alias(name)
        return F.when(is_new, F.col(f"__new.`{name}`")).otherwise(F.col(f"__old.`{name}`").cast(new.schema[name].dataType)).alias(name)

    return joined.select(*[pick(n, keys.index(n) if n in keys else None) for n in new.columns])
