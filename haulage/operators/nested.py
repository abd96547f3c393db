"""Arrays of objects to flat rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

_ELEMENT = "__element"
_PLACE = "__place"


def explode_records(
    df: DataFrame,
    array: str | Column,
    parents: Mapping[str, str | Column],
    fields: Mapping[str, str | Callable[[Column], Column]],
    position: str | None = None,
    check: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per array element, with the parent columns repeated on each.

    ``parents`` maps output names to columns of ``df``; ``fields`` maps output
    names to paths inside the element, or to functions of it. ``position`` adds
    the element's place in its array. ``check`` is applied to each element
    before its fields are taken. A row with an empty array gives no rows.

    Nothing is shuffled: elements stay in the partition of their parent row,
    and only the fields named here are read from the source.
    """
    array = F.col(array) if isinstance(array, str) else array
    kept = [_named(expr, name) for name, expr in parents.items()]
    if position:
        exploded = df.select(*kept, F.posexplode(array).alias(_PLACE, _ELEMENT))
    else:
        exploded = df.select(*kept, F.explode(array).alias(_ELEMENT))
    if check:
        exploded = exploded.withColumn(_ELEMENT, check(F.col(_ELEMENT)))

    out = [F.col(f"`{name}`") for name in parents]
    if position:
        out.append(F.col(_PLACE).alias(position))
    for name, field in fields.items():
        value = F.col(f"{_ELEMENT}.{field}") if isinstance(field, str) else field(F.col(_ELEMENT))
        out.append(value.alias(name))
    return exploded.select(*out)


def field_of_each(
    df: DataFrame,
    array: str | Column,
    field: str,
    parents: Mapping[str, str | Column] | None = None,
    position: str = "pos",
    check: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One field of every array element, with the element's place."""
    return explode_records(df, array, parents or {}, {field: field}, position, check)


def _named(expr: str | Column, name: str) -> Column:
    return (F.col(expr) if isinstance(expr, str) else expr).alias(name)
