"""CSV types found while the text is staged, so that the CSV is parsed once.

Spark's own inference reads a CSV, picks types, and reads it again. Here one pass
writes all values as text to Parquet and adds up, per column, which types
every value fits; the typed table is a cast of the staged columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulage.operators.checks import observed_metrics
from haulage.session import scratch_dir, session_setting
from haulage.sources.files import CsvDialect, PLAIN, read_csv, read_parquet

#: In the order they are tried. A column gets the first type that all its values fit.
KINDS = ("int", "bigint", "decimal", "double", "date", "timestamp", "boolean")

#: The flags of some ten columns are more code than the JVM compiles as one method. With
#: this limit Spark then divides them into methods of their own.
SMALL_METHODS = ("spark.sql.codegen.hugeMethodLimit", "8000")

#: Every text that a cast takes for a number matches, and few others do. A failed cast to
#: double costs an exception, so texts that can't be numbers are told apart before.
_NUMBER = (
    r"(?i)^[\x00-\x20]*[+-]?(?:inf(?:inity)?|nan|[0-9.][0-9a-fx.]*(?:[ep][+-]?[0-9]+)?[fd]?)"
    r"[\x00-\x20]*$"
)
_WHOLE = r"^[+-]?\d{1,38}$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_DATED = r"^\d{4}-\d{1,2}"


def fitting(text: Column) -> Column:
    """A number whose bits say which of ``KINDS`` a text fits; all bits for null.

    What fits int fits the wider numbers too, and a date is a timestamp, so few texts are
    cast more than once.
    """
    trimmed = F.trim(text)

    def fits(kind: str) -> Column:
        return trimmed.try_cast(kind).isNotNull()

    def bits(*kinds: str) -> Column:
        return F.lit(sum(1 << KINDS.index(kind) for kind in kinds))

    number = F.when(fits("double"), bits("double")).otherwise(0)
    whole = (
        F.when(fits("int"), bits("int", "bigint", "decimal", "double"))
        .when(fits("bigint"), bits("bigint", "decimal", "double"))
        .otherwise(number + bits("decimal"))
    )
    time = (
        F.when(trimmed.rlike(_DATE) & fits("date"), bits("date", "timestamp"))
        .when(fits("timestamp"), bits("timestamp"))
        .otherwise(0)
    )
    return (
        F.when(text.isNull(), bits(*KINDS))
        .when(trimmed.rlike(_WHOLE), whole)
        .when(trimmed.rlike(_NUMBER), number)
        .when(trimmed.rlike(_DATED), time)
        .when(F.lower(trimmed).isin("true", "false"), bits("boolean"))
        .otherwise(0)
    )


def decimal_digits(text: Column, fits: Column) -> Column:
    """How many digits a whole number beyond 64 bits has; 0 for other texts, null for null."""
    decimal, bigint = (1 << KINDS.index(kind) for kind in ("decimal", "bigint"))
    beyond = fits.bitwiseAND(F.lit(decimal | bigint)) == decimal
    digits = F.length(F.regexp_replace(F.trim(text), "^[+-]?0*", ""))
    return F.when(text.isNotNull(), F.when(beyond, digits).otherwise(0))


def chosen_type(bits: int | None, filled: bool, digits: int | None) -> T.DataType:
    """The type for a column from what was added up; text if nothing else fits."""
    if not filled or not bits:
        return T.StringType()
    kind = next(kind for i, kind in enumerate(KINDS) if bits >> i & 1)
    types = {
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "decimal": T.DecimalType(min(digits or 38, 38), 0),
        "double": T.DoubleType(),
        "date": T.DateType(),
        "timestamp": T.TimestampType(),
        "boolean": T.BooleanType(),
    }
    return types[kind]


def stage_inferred(df: DataFrame, path: str | None = None) -> DataFrame:
    """A table of texts, staged as Parquet at ``path`` and cast to the types its values have.

    The types are those that Spark infers for a CSV: whole numbers by size, decimals for
    whole numbers beyond 64 bits, then double, date, timestamp, boolean, else text. A column
    without any value is text. The flags are columns of the writing stage (generated code);
    only the bitwise AND, the longest number and a count are left to the observation.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, "staged")
    fits, digits, metrics = {}, {}, []
    for i, name in enumerate(df.columns):
        column = F.col(f"`{name}`")
        fits[f"__fits{i}"] = fitting(column)
        digits[f"__long{i}"] = decimal_digits(column, F.col(f"__fits{i}"))
        metrics += [
            F.bit_and(f"__fits{i}").alias(f"fits{i}"),
            F.max(f"__long{i}").alias(f"long{i}"),
        ]
    flagged = df.withColumns(fits).withColumns(digits)
    with session_setting(spark, *SMALL_METHODS):
        found = observed_metrics(
            flagged, lambda out: out.write.mode("overwrite").parquet(path), metrics, [*fits, *digits]
        )
    staged = spark.read.schema(df.schema).parquet(path)
    typed = []
    for i, name in enumerate(df.columns):
        kind = chosen_type(found[f"fits{i}"], found[f"long{i}"] is not None, found[f"long{i}"])
        column = F.col(f"`{name}`")
        typed.append((column if isinstance(kind, T.StringType) else F.trim(column).cast(kind)).alias(name))
    return staged.select(*typed)


def read_csv_inferred(
    spark: SparkSession,
    path: str | Sequence[str],
    dialect: CsvDialect = PLAIN,
    staged: str | None = None,
    **options: str,
) -> DataFrame:
    """CSV with inferred types by one read of the files; see :func:`stage_inferred`."""
    return stage_inferred(read_csv(spark, path, dialect=dialect, **options), staged)
