"""Data checks: readiness, required values, written data."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from haulage.functions.required import require


class CheckFailed(RuntimeError):
    """The data is not what the job needs or wrote."""


@dataclass(frozen=True)
class Fingerprint:
    """Row count and order-free checksum of a table (checksum None: not taken)."""

    rows: int
    checksum: int | None = None


def fingerprint(df: DataFrame, checksum: bool = True) -> DataFrame:
    """``rows`` and ``checksum`` in one pass, as a one-row DataFrame.

    The checksum adds up a 64-bit hash per row, so rows that occur twice count
    twice. ``xxhash64`` skips nulls; a null flag per column keeps ``(a, null)``
    and ``(null, a)`` apart.
    """
    if not checksum:
        return df.agg(*_totals(False))
    totals = _with_row_hash(df).agg(*_totals(True))
    whole = "decimal(38,0)"
    total = F.lit(0).cast(whole)
    for i in range(_PIECES):
        weight = F.lit(1 << (_PIECE_BITS * i)).cast(whole)
        total += F.coalesce(F.col(f"piece{i}"), F.lit(0)).cast(whole) * weight
    return totals.select("rows", total.cast(whole).alias("checksum"))


def take_fingerprint(df: DataFrame, checksum: bool = True) -> Fingerprint:
    """Count and, unless told not to, hash the rows of ``df``."""
    hashed = _with_row_hash(df) if checksum else df
    return _as_fingerprint(hashed.agg(*_totals(checksum)).first().asDict())


def observed_metrics(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    metrics: Iterable[Column],
    drop: Iterable[str] = (),
) -> dict:
    """Write ``df`` and return aggregates of the rows that passed to the writer.

    The source is scanned once. ``write`` must add no shuffle of its own:
    metrics from a stage before a shuffle would be counted again if a lost
    executor made Spark repeat part of it. Columns in ``drop`` are there for
    the metrics only.
    """
    watch = Observation()
    write(df.observe(watch, *metrics).drop(*drop))
    return watch.get


def observed_write(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    checksum: bool = False,
) -> Fingerprint:
    """:func:`observed_metrics` for the fingerprint of the rows written.

    Observing is done row by row, outside generated code. So the hash is a
    column, computed before, and only whole numbers are left to add up.
    """
    source = _with_row_hash(df) if checksum else df
    return _as_fingerprint(observed_metrics(source, write, _totals(checksum), [_ROW_HASH]))


def verify(written: Fingerprint, target: DataFrame, what: str) -> Fingerprint:
    """Read the target back; raise unless it holds exactly what was written."""
    found = take_fingerprint(target, written.checksum is not None)
    if found != written:
        raise CheckFailed(f"{what}: wrote {written}, read back {found}")
    return found


def enforce_required(df: DataFrame, names: Iterable[str], what: str) -> DataFrame:
    """``df`` unchanged, but using a required column that is null fails the job.

    The check costs no pass of its own; see :mod:`haulage.functions.required`.
    """
    columns = {name: F.col(f"`{name}`") for name in names}
    return df.withColumns({name: require(col, columns, what) for name, col in columns.items()})


def missing_counts(df: DataFrame, required: Iterable[str] | Mapping[str, Column]) -> DataFrame:
    """Per required column, how many rows have it null (``missing_<name>``), and ``rows``."""
    if not isinstance(required, Mapping):
        required = {name: F.col(name) for name in required}
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(col.isNull()).alias(f"missing_{name}") for name, col in required.items()],
    )


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[str]:
    """What ``actual`` lacks or types differently; extra columns are fine."""
    found = {field.name: field.dataType for field in actual.fields}
    problems = []
    for field in expected.fields:
        if field.name not in found:
            problems.append(f"{field.name}: missing")
        elif found[field.name] != field.dataType:
            problems.append(
                f"{field.name}: {found[field.name].simpleString()}"
                f" instead of {field.dataType.simpleString()}"
            )
    return problems


def assert_ready(
    df: DataFrame,
    columns: Iterable[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Gate before a job: right columns, right types, at least one row.

    The schema is checked first, for free; the row check reads one row.
    """
    absent = [name for name in columns if name not in df.columns]
    problems = [f"{name}: missing" for name in absent]
    if schema is not None:
        problems += schema_differences(df.schema, schema)
    if problems:
        raise CheckFailed("source is not ready: " + "; ".join(problems))
    if df.isEmpty():
        raise CheckFailed("source is not ready: no rows")
    return df


# A row hash is added up in pieces: sums of 16 bits stay below 2**63 for 2**47 rows.
_ROW_HASH = "__row_hash"
_PIECE_BITS = 16
_PIECES = 4


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns; nulls count by their place."""
    inputs: list[Column] = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.MapType, T.VariantType)):
            col = F.to_json(F.struct(col.alias("value")))  # Spark hashes neither
        inputs += [col, col.isNull()]
    return F.xxhash64(*inputs)


def _with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn(_ROW_HASH, row_hash(df))


def _totals(checksum: bool) -> list[Column]:
    totals = [F.count(F.lit(1)).alias("rows")]
    if checksum:
        mask = (1 << _PIECE_BITS) - 1
        for i in range(_PIECES):
            piece = F.shiftrightunsigned(_ROW_HASH, _PIECE_BITS * i).bitwiseAND(F.lit(mask))
            totals.append(F.sum(piece).alias(f"piece{i}"))
    return totals


def _as_fingerprint(metrics: Mapping) -> Fingerprint:
    if "piece0" not in metrics:
        return Fingerprint(int(metrics["rows"]))
    pieces = [int(metrics[f"piece{i}"] or 0) for i in range(_PIECES)]
    return Fingerprint(
        int(metrics["rows"]), sum(p << (_PIECE_BITS * i) for i, p in enumerate(pieces))
    )
