"""CSV, Parquet and JSON readers for any path Spark can open (``s3a://`` too)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulage import storage


@dataclass(frozen=True)
class CsvDialect:
    """How CSV text is written and read back; one object serves both ways."""

    separator: str = ","
    shared: dict[str, str] = field(default_factory=dict)
    write_only: dict[str, str] = field(default_factory=dict)
    read_only: dict[str, str] = field(default_factory=dict)
    #: Line breaks in texts are written as escapes, so that files can be split anywhere.
    one_line: bool = False

    def writing(self) -> dict[str, str]:
        return {"header": "true", "sep": self.separator, **self.shared, **self.write_only}

    def reading(self) -> dict[str, str]:
        return {"header": "true", "sep": self.separator, **self.shared, **self.read_only}

    def with_separator(self, separator: str) -> CsvDialect:
        return replace(self, separator=separator)


#: How times are written: with microseconds, which is all that Spark holds.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

#: Spark's own CSV rules. Empty text comes back null, outer spaces are trimmed
#: and a line break inside a value splits the row. Files can be split by size.
PLAIN = CsvDialect(write_only=MICROSECONDS)

#: CSV as most tools write it: line breaks and doubled quotes inside quoted values.
#: A file is then read by one task.
STANDARD = CsvDialect(
    shared={"escape": '"'}, write_only=MICROSECONDS, read_only={"multiLine": "true"}
)

#: Gives every value back as written. A row is one line: in texts, a line break is written
#: ``\\n``, a carriage return ``\\r`` and a backslash ``\\s``; null is ``\\N``, which no
#: text can be. So a file of any size is read by as many tasks as its size calls for.
LOSSLESS = CsvDialect(
    shared={"nullValue": "\\N", "escape": '"'},
    write_only={
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        **MICROSECONDS,
    },
    one_line=True,
)

# What stands for what inside a text; the backslash comes first when
# writing and last when reading.
_ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0"))


def _replaced(column: Column, pairs) -> Column:
    for old, new in pairs:
        column = F.replace(column, F.lit(old), F.lit(new))
    return column


def _on_texts(df: DataFrame, change, keep: Sequence[str] = ()) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in keep]
    return df.withColumns({name: change(F.col(f"`{name}`")) for name in texts}) if texts else df


def encoded(df: DataFrame, dialect: CsvDialect) -> DataFrame:
    """The texts of a table as the dialect writes them."""
    return _on_texts(df, lambda column: _replaced(column, _ESCAPES)) if dialect.one_line else df


def decoded(df: DataFrame, dialect: CsvDialect, keep: Sequence[str] = ()) -> DataFrame:
    """The texts of a table as they were, all but the columns ``keep``."""
    back = [(new, old) for old, new in reversed(_ESCAPES)]
    return _on_texts(df, lambda column: _replaced(column, back), keep) if dialect.one_line else df


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    infer: bool = False,
    dialect: CsvDialect = PLAIN,
    **options: str,
) -> DataFrame:
    """CSV with a header line.

    All columns are strings unless ``infer`` is set, which reads the data one
    extra time, or ``schema`` is given, which does not. Prefer a schema for
    large inputs.

    Reads are strict: a value of another type, a row with more or fewer values
    and a header ordered or named differently fail the job. Pass
    ``mode="PERMISSIVE"`` or ``enforceSchema="true"`` for Spark's defaults.
    """
    strict = {"mode": "FAILFAST", "enforceSchema": "false"}
    reader = spark.read.options(**{**strict, **dialect.reading(), **options})
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return decoded(reader.csv(path if isinstance(path, str) else list(path)), dialect)


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str | None = None,
    dialect: CsvDialect = PLAIN,
    pattern: str = "*.csv",
) -> DataFrame:
    """Every matching CSV file of a folder as one table, types inferred.

    A file whose header is ordered or named differently makes the read fail;
    by default Spark would put its values into the wrong columns. :func:`read_csv_by_name`
    takes such files.
    """
    return read_csv(
        spark,
        f"{folder.rstrip('/')}/{pattern}",
        schema=schema,
        infer=schema is None,
        dialect=dialect,
    )


#: More unlike headers than this in one folder are taken for a mistake.
MAX_HEADERS = 200


def read_csv_by_name(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str | None = None,
    dialect: CsvDialect = PLAIN,
    pattern: str = "*.csv",
    extra_columns: bool = True,
) -> DataFrame:
    """CSV files with unlike headers as one table, values matched by column name.

    The first line of each file is read (nothing more of it crosses the network); files with one header are one strict
    read, and the reads are united by name. A column that a file lacks is null in its rows.
    All columns are text unless ``schema`` types them; a column outside the schema
    is kept as text, or left out without ``extra_columns``. Two columns of one name in a file,
    and more than ``MAX_HEADERS`` headers, are errors.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    groups: dict[str, list[str]] = {}
    for path, line in storage.first_lines(spark, f"{folder.rstrip('/')}/{pattern}"):
        if line is not None:  # an empty file has neither header nor rows
            groups.setdefault(line, []).append(path)
    if not groups:
        raise FileNotFoundError(f"no CSV file with a header matches {folder.rstrip('/')}/{pattern}")
    if len(groups) > MAX_HEADERS:
        raise ValueError(f"{len(groups)} unlike headers in {folder}, at most {MAX_HEADERS} are expected")
    types = {f.name: f.dataType for f in wanted.fields} if wanted else {}
    parts = []
    for paths in groups.values():
        names = spark.read.options(**{**dialect.reading(), "inferSchema": "false"}).csv(paths[0]).columns
        own = T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in names])
        parts.append(read_csv(spark, paths, own, dialect=dialect))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    if wanted is None:
        return united
    columns = [
        F.col(f"`{f.name}`") if f.name in united.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields
    ]
    extra = [f"`{name}`" for name in united.columns if name not in types] if extra_columns else []
    return united.select(*columns, *extra)


def landed_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``path, length, modified`` of the files below a folder; no file is opened.

    Files whose names begin with ``_`` or ``.`` are not data and are left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def landed_by_date(spark: SparkSession, path: str, date_column: str = "load_date") -> DataFrame:
    """Per load date of a dated folder: ``files``, ``bytes``, ``smallest`` and ``latest`` (when written)."""
    date = F.regexp_extract("path", f"/{date_column}=([^/]+)/[^/]+$", 1)
    files = landed_files(spark, path).withColumn(date_column, F.nullif(date, F.lit("")))
    return files.filter(F.col(date_column).isNotNull()).groupBy(date_column).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.min("length").alias("smallest"),
        F.max("modified").alias("latest"),
    )


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet files; filters and column choice reach the scan."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_json_documents(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    multi_line: bool = True,
) -> DataFrame:
    """JSON documents with a declared schema; malformed input fails the job.

    ``multi_line`` reads one document per file (files are packed into tasks by
    size). Turn it off for JSON Lines, which Spark can split anywhere.
    """
    return (
        spark.read.schema(schema)
        .options(mode="FAILFAST", multiLine=str(multi_line).lower())
        .json(path if isinstance(path, str) else list(path))
    )


def read_load_dates(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    date_column: str = "load_date",
) -> DataFrame:
    """JSON Lines written per load date, the date column kept as text.

    The schema names the date column too; without that Spark would read
    ``20260101`` as a number. Filters on it skip whole folders.
    """
    if date_column not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(date_column, T.StringType())])
    return read_json_documents(spark, path, schema, multi_line=False)
