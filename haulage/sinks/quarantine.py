"""Good and bad rows written apart, in one pass over the source."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulage import storage
from haulage.operators.checks import CheckFailed, observed_metrics
from haulage.sinks.files import open_writers
from haulage.sources.tolerant import BAD_ROW, FILE

REASON = "_reason"


@dataclass(frozen=True)
class Quarantine:
    """How many rows went where."""

    good: int
    bad: int


def reason_of(required: Iterable[str]) -> Column:
    """Why a row of a tolerant read is bad, or null: it can't be read, or a required value is missing."""
    missing = [F.when(F.col(f"`{name}`").isNull(), F.lit(name)) for name in required]
    named = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
    lacking = F.concat(F.lit("missing "), F.array_join(named, ", "))
    return F.when(F.col(BAD_ROW).isNotNull(), "malformed").when(F.size(named) > 0, lacking)


def write_apart(
    df: DataFrame,
    path: str,
    required: Iterable[str] = (),
    max_bad_share: float = 0.01,
) -> Quarantine:
    """Write the rows of a tolerant read below ``path``, good and bad ones apart.

    Both parts come from one pass, and one replaces the other's old version together. If more
    than ``max_bad_share`` of the rows are bad the job fails: the old parts stay, and
    the bad rows are left at ``<path>-rejected`` to be looked at. An empty input is no failure.
    """
    spark = df.sparkSession
    base = path.rstrip("/")
    judged = df.withColumn(REASON, reason_of(required))
    good = F.col(REASON).isNull()
    marked = judged.withColumn("good", good)
    with storage.replacing(spark, f"{base}/rows") as (rows,):
        with open_writers(spark):
            counts = observed_metrics(
                marked,
                lambda out: out.write.partitionBy("good").parquet(rows),
                [F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")],
            )
        found = Quarantine(counts["good"], counts["bad"])
        if found.bad > max_bad_share * (found.good + found.bad):
            rejected = f"{base}-rejected"
            with storage.replacing(spark, rejected) as (target,):
                spark.read.schema(judged.schema).parquet(f"{rows}/good=false").write.parquet(target)
            raise CheckFailed(f"{found.bad} of {found.good + found.bad} rows are bad, more than {max_bad_share:.2%}; see {rejected}")
    return found


def good_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The good rows below ``path``, with the columns of ``schema``."""
    return _part(spark, path, schema, True).select(*[f"`{name}`" for name in schema.fieldNames()])


def bad_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The bad rows: ``_reason``, ``_bad_row``, ``_file`` and what could be read of each."""
    return _part(spark, path, schema, False)


def _part(spark: SparkSession, path: str, schema: T.StructType, good: bool) -> DataFrame:
    extra = [T.StructField(name, T.StringType()) for name in (BAD_ROW, FILE, REASON)]
    whole = T.StructType([*schema.fields, *extra, T.StructField("good", T.BooleanType())])
    return spark.read.schema(whole).parquet(f"{path.rstrip('/')}/rows").filter(F.col("good") == good).drop("good")
