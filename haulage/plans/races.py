"""Race documents -> one flat record per result, stored by load date.

Values whose JSON type the documents do not fix are read as variants. That
keeps three things apart which a typed schema would merge: a key that is
absent (an error), a key that is null (a legal value) and the type of the
value, which is written back out as it came in.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulage.functions import as_date_text, concat_strict, falsy_to_null, require
from haulage.operators import Fingerprint, assert_ready, explode_records
from haulage.schema import struct_of
from haulage.sinks import replace_load_dates
from haulage.sources import read_json_documents, read_load_dates

_ANY = T.VariantType()
_TEXT = T.StringType()

DOCUMENT = struct_of(
    season=_ANY,
    races=struct_of(
        raceId=_ANY,
        raceName=_ANY,
        round=_ANY,
        date=_ANY,
        circuit=struct_of(circuitId=_ANY, circuitName=_ANY),
        results=T.ArrayType(
            struct_of(
                driver=struct_of(driverId=_ANY, name=_TEXT, surname=_TEXT),
                team=struct_of(teamId=_ANY, teamName=_ANY),
                position=_ANY,
                grid=_ANY,
                points=_ANY,
                time=_ANY,
                fastLap=_ANY,
                retired=_ANY,
            )
        ),
    ),
)

RECORD = struct_of(
    race_id=_TEXT,
    race_name=_TEXT,
    race_season=T.IntegerType(),
    race_round=T.IntegerType(),
    race_date=_TEXT,
    circuit_id=_TEXT,
    circuit_name=_TEXT,
    driver_id=_TEXT,
    driver_name=_TEXT,
    team_id=_TEXT,
    team_name=_TEXT,
    position=_TEXT,
    grid_position=_TEXT,
    points=T.DoubleType(),
    time=_TEXT,
    fastest_lap_time=_TEXT,
    retired=_TEXT,
)

# The output contract. Output name -> place in the document.
RACE_FIELDS = {
    "race_id": "races.raceId",
    "race_name": "races.raceName",
    "race_season": "season",
    "race_round": "races.round",
    "race_date": "races.date",
    "circuit_id": "races.circuit.circuitId",
    "circuit_name": "races.circuit.circuitName",
}

RESULT_FIELDS = {
    "driver_id": "driver.driverId",
    "driver_name": lambda r: concat_strict(_at(r, "driver.name"), F.lit(" "), _at(r, "driver.surname")),
    "team_id": "team.teamId",
    "team_name": "team.teamName",
    "position": "position",
    "grid_position": "grid",
    "points": "points",
    "time": "time",
    "fastest_lap_time": lambda r: falsy_to_null(r["fastLap"], _ANY),
    "retired": lambda r: falsy_to_null(r["retired"], _ANY),
}

# Keys every result must have. Only fastLap and retired may be absent.
RESULT_KEYS = (
    "driver.driverId",
    "driver.name",
    "driver.surname",
    "team.teamId",
    "team.teamName",
    "position",
    "grid",
    "points",
    "time",
)


def flatten(documents: DataFrame) -> DataFrame:
    """One record per result, race columns repeated; no shuffle.

    A document without results gives no record. A document or result that
    lacks a required key fails the job.
    """
    race_keys = [*RACE_FIELDS.values(), "races.results"]
    results = require(
        F.col("races.results"), {key: F.col(key) for key in race_keys}, "race document"
    )
    return explode_records(documents, results, RACE_FIELDS, RESULT_FIELDS, check=_complete)


def typed(records: DataFrame) -> DataFrame:
    """Flat records with the declared column types instead of variants or text.

    Numbers may be given as text. What is no number of its column's type (a round
    of 1.5) is null here; stored records keep it as it came in.
    """
    return records.select(
        [_as_declared(f).alias(f.name) for f in RECORD.fields]
        + [F.col(name) for name in records.columns if name not in RECORD.fieldNames()]
    )


def load_date_of(run_date: dt.date | str) -> str:
    """Load date of a run: the day before it, as ``YYYYMMDD``."""
    day = dt.date.fromisoformat(as_date_text(run_date))
    return (day - dt.timedelta(days=1)).strftime("%Y%m%d")


def run(
    spark: SparkSession,
    documents_path: str,
    output_path: str,
    run_date: dt.date | str,
    multi_line: bool = True,
    compression: str | None = None,
) -> Fingerprint:
    """Flatten all landed documents into the folder of the run's load date.

    ``compression`` is that of the files written.
    """
    documents = assert_ready(
        read_json_documents(spark, documents_path, DOCUMENT, multi_line)
    )
    load_date = load_date_of(run_date)
    records = flatten(documents).withColumn("load_date", F.lit(load_date))
    return replace_load_dates(records, output_path, dates=[load_date], compression=compression)


def read_results(spark: SparkSession, output_path: str) -> DataFrame:
    """Stored records of all load dates, typed; every stored record can be read."""
    as_text = struct_of(**dict.fromkeys(RECORD.fieldNames(), _TEXT))
    return typed(read_load_dates(spark, output_path, as_text))


def _as_declared(field: T.StructField) -> Column:
    text = F.col(field.name).cast(_TEXT)
    if field.dataType == _TEXT:
        return text
    number = text.try_cast("double")
    if field.dataType == T.DoubleType():
        return number
    whole = number.try_cast(field.dataType)
    return F.when(whole == number, whole)


def _complete(result: Column) -> Column:
    return require(result, {key: _at(result, key) for key in RESULT_KEYS}, "race result")


def _at(record: Column, path: str) -> Column:
    for key in path.split("."):
        record = record[key]
    return record
