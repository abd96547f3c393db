"""Named runs of every operator over the benchmark tables.

Each entry is a function ``(spark, sf_dir) -> DataFrame`` with the SQL that
must give the same rows. All of them work on whole tables. Entries that write
do so under the shared folder (``spark.checkpoint.dir``), in a new path per
call, and these are deleted when the application ends. Where a table has no
nulls, the entry and its SQL make the same ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulage import storage
from haulage.functions import (
    concat_strict,
    falsy_to_null,
    has_scheme,
    join_text,
    json_field,
    json_text,
    last_segment,
    load_date_key,
    map_code,
    season_of,
)
from haulage.operators import (
    assert_ready,
    differences,
    enforce_required,
    fingerprint,
    keep_in,
    keep_present,
    missing_counts,
    preview,
    row_count,
    schema_differences,
    with_constants,
)
from haulage.plans import customer, launches, parquet_copy, races, replicate, staging
from haulage.schema import struct_of
from haulage.session import scratch_dir, session_dir, session_setting
from haulage.sinks import (
    bad_rows,
    compressed,
    create_namespace,
    drop_load_date,
    drop_table_load_date,
    drop_tables,
    good_rows,
    jdbc_catalog,
    load_table,
    replace_load_dates,
    replace_table,
    write_apart,
    write_csv,
    write_parquet,
    write_table,
)
from haulage.sources import (
    LOSSLESS,
    Split,
    count_rows,
    landed_by_date,
    query_catalog,
    read_catalog_table,
    read_csv,
    read_csv_by_name,
    read_csv_folder,
    read_csv_inferred,
    read_json_documents,
    read_csv_tolerant,
    read_json_tolerant,
    read_load_dates,
    read_parquet,
    read_query,
    read_table,
)
from haulage.sources.embedded import working_endpoint
from haulage.sources.jdbc import quoted

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}

RUN_DATE = "2026-03-07"


def registered(sql: str, name: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name, or ``name``, with its SQL."""

    def add(run: Run) -> Run:
        QUERIES[name or run.__name__] = run
        SQL[name or run.__name__] = sql
        return run

    return add


def open_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


# --- customer dimension ------------------------------------------------------


def customer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table in the shape of the dimension's source."""
    segment = F.col("c_mktsegment")
    return open_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerKey"),
        F.col("c_name").alias("FirstName"),
        F.nullif(segment, F.lit("FURNITURE")).alias("LastName"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 365).alias("BirthDate"),
        F.substring(segment, 1, 1).alias("Gender"),
        F.when(
            segment != "BUILDING",
            F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")),
        ).alias("EmailAddress"),
    )


CUSTOMER_SQL = """
    SELECT c_custkey AS "CustomerKey", c_name AS "FirstName",
           NULLIF(c_mktsegment, 'FURNITURE') AS "LastName",
           strftime(DATE '1950-01-01' + c_nationkey * 365, '%Y-%m-%d') AS "BirthDate",
           substr(c_mktsegment, 1, 1) AS "Gender",
           CASE WHEN c_mktsegment <> 'BUILDING'
                THEN 'c' || c_custkey || '@example.com' END AS "EmailAddress"
    FROM customer
"""

DIM_SQL = f"""
    SELECT "CustomerKey", "FirstName", "LastName",
           concat_ws(', ', "FirstName", "LastName") AS "FullName", "BirthDate",
           CASE "Gender" WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'Unknown' END AS "Gender",
           "EmailAddress", 'AdventureWorks' AS "DBSource", '{RUN_DATE}' AS "IngestionDate"
    FROM ({CUSTOMER_SQL}) WHERE "EmailAddress" IS NOT NULL
"""

DIM_TEXT_SQL = f"SELECT COLUMNS(*)::VARCHAR FROM ({DIM_SQL})"


@registered(DIM_SQL)
def dim_customer_etl(spark, sf_dir):
    dimension = customer.conform(customer_source(spark, sf_dir), RUN_DATE)
    return dimension.withColumn("BirthDate", F.col("BirthDate").cast("string"))


@registered(DIM_TEXT_SQL)
def csv_roundtrip(spark, sf_dir):
    dimension = customer.conform(customer_source(spark, sf_dir), RUN_DATE)
    base = scratch_dir(spark, "csv")
    landed, _, _ = customer.land_csv(dimension, base, "customer", RUN_DATE)
    return landed


@registered(DIM_TEXT_SQL)
def jdbc_roundtrip(spark, sf_dir):
    source = working_endpoint(spark, "source")
    target = working_endpoint(spark, "target")
    base = scratch_dir(spark, "customer")
    given, staged = new_table("customer"), new_table("stg_customer")
    write_table(customer_source(spark, sf_dir), source, given)
    try:
        customer.run(
            spark, source, target, base, RUN_DATE, source_table=given, staging_table=staged
        )
        return landed(read_table(spark, target, staged))
    finally:
        storage.remove(spark, base)
        drop_tables(spark, source, [given])
        drop_tables(spark, target, [staged])


@registered(f'SELECT * FROM ({CUSTOMER_SQL}) WHERE "EmailAddress" IS NOT NULL')
def filter_not_null(spark, sf_dir):
    kept = keep_present(customer_source(spark, sf_dir), "EmailAddress")
    return kept.withColumn("BirthDate", F.col("BirthDate").cast("string"))


@registered(
    f"""SELECT "CustomerKey", concat_ws(', ', "FirstName", "LastName") AS full_name
        FROM ({CUSTOMER_SQL})"""
)
def concat_ws_name(spark, sf_dir):
    full_name = join_text(", ", "FirstName", "LastName").alias("full_name")
    return customer_source(spark, sf_dir).select("CustomerKey", full_name)


@registered(
    f"""SELECT "CustomerKey", CASE "Gender" WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female'
               ELSE 'Unknown' END AS gender FROM ({CUSTOMER_SQL})"""
)
def case_code_map(spark, sf_dir):
    gender = map_code("Gender", customer.GENDER_LABELS, customer.UNKNOWN).alias("gender")
    return customer_source(spark, sf_dir).select("CustomerKey", gender)


@registered(
    f"""SELECT c_custkey, c_name, 'AdventureWorks' AS db_source, '{RUN_DATE}' AS ingestion_date
        FROM customer"""
)
def constant_columns(spark, sf_dir):
    keyed = open_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return with_constants(keyed, db_source=customer.SOURCE_NAME, ingestion_date=RUN_DATE)


# --- JDBC --------------------------------------------------------------------


def new_table(name: str) -> str:
    """A table name of this call alone: the database may hold tables of others."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def landed(df: DataFrame) -> DataFrame:
    """Rows as files in the shared folder, so that what they came from can go."""
    path = scratch_dir(df.sparkSession, "landed")
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


def even_split(spark: SparkSession, rows: int, *columns: str) -> Split:
    """As many reads as tasks run at once."""
    return Split(columns, target_rows=max(1, -(-rows // spark.sparkContext.defaultParallelism)))


@registered("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def jdbc_query_scan(spark, sf_dir):
    database, name = working_endpoint(spark, "source"), new_table("customer")
    write_table(open_table(spark, sf_dir, "customer"), database, name)
    try:
        split = even_split(spark, count_rows(spark, database, name), "c_custkey")
        rows = read_query(spark, database, f'SELECT * FROM {name} WHERE "c_acctbal" > 0', split)
        return landed(rows.select("c_custkey", "c_name", "c_acctbal"))
    finally:
        drop_tables(spark, database, [name])


@registered(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"""
)
def jdbc_partitioned_scan(spark, sf_dir):
    database, name = working_endpoint(spark, "source"), new_table("orders")
    write_table(open_table(spark, sf_dir, "orders"), database, name)
    try:
        split = even_split(spark, count_rows(spark, database, name), "o_orderkey")
        orders = landed(read_table(spark, database, name, split))
    finally:
        drop_tables(spark, database, [name])
    return orders.withColumn("o_orderdate", day_text("o_orderdate"))


# Whole rows as text; amounts in cents.
REPLICATED = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "orders": (
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    ),
}
AMOUNTS = ("s_acctbal", "p_retailprice", "c_acctbal", "o_totalprice")


def row_text_sql(columns: tuple[str, ...]) -> str:
    def text(c: str) -> str:
        if c in AMOUNTS:
            c = f"CAST(round({c} * 100) AS BIGINT)"
        elif c == "o_orderdate":
            c = f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
        return f"coalesce(CAST({c} AS VARCHAR), '')"

    return f"concat_ws('|', {', '.join(map(text, columns))})"


def row_text(df: DataFrame, columns: tuple[str, ...]) -> Column:
    def text(c: str) -> Column:
        value = F.col(c)
        if c in AMOUNTS:
            value = F.round(value * 100).cast("long")
        elif c == "o_orderdate":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return F.coalesce(value.cast("string"), F.lit(""))

    return F.concat_ws("|", *map(text, columns))


@registered(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'loaded' AS status, count(*) OVER () AS source_rows,"
        f" count(*) OVER () AS target_rows, {row_text_sql(columns)} AS row_text FROM {name}"
        for name, columns in REPLICATED.items()
    )
)
def replicate_tables(spark, sf_dir):
    source = working_endpoint(spark, "source")
    target = working_endpoint(spark, "target")
    # names that need quoting keep their letters' case in every database
    mark = f"h-{uuid.uuid4().hex[:12]}"
    names, prefix = {f"{mark}-{name}": name for name in REPLICATED}, "src-"
    try:
        for key, name in names.items():
            write_table(open_table(spark, sf_dir, name), source, quoted(key))
        rows = max(count_rows(spark, source, quoted(key)) for key in names)
        report = replicate.run(
            spark, source, target, names, None, prefix, even_split(spark, rows)
        )
        rows_of = []
        for done in report.collect():  # a row per table
            name = names[done.table_name]
            columns = [F.lit(v) for v in (name, done.status, done.source_rows, done.target_rows)]
            if done.status == "loaded":
                content = read_table(
                    spark, target, quoted(prefix + done.table_name), even_split(spark, rows)
                )
                text = row_text(content, REPLICATED[name])
            else:
                content, text = spark.range(1), F.lit(None).cast("string")
            known_as = ("table_name", "status", "source_rows", "target_rows", "row_text")
            rows_of.append(content.select(*map(Column.alias, [*columns, text], known_as)))
        return landed(reduce(DataFrame.unionByName, rows_of))
    finally:
        drop_tables(spark, source, names)
        drop_tables(spark, target, [prefix + key for key in names])


@registered(
    """SELECT 'after a failed load' AS step, s_suppkey, s_name, s_acctbal FROM supplier
       UNION ALL SELECT 'after the load', s_suppkey, 'new ' || s_name, s_acctbal FROM supplier
       WHERE s_nationkey <> 3"""
)
def jdbc_swap(spark, sf_dir):
    # A load that breaks in the database, after rows went in, leaves the old rows readable.
    database, name = working_endpoint(spark, "target"), new_table("supplier")
    suppliers = open_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    renamed = suppliers.withColumn("s_name", F.concat(F.lit("new "), "s_name"))
    too_long = F.when(F.col("s_suppkey") % 2 == 0, F.repeat("s_name", 20)).otherwise(F.col("s_name"))
    try:
        load_table(suppliers, database, name)
        try:
            load_table(renamed.withColumn("s_name", too_long), database, name, createTableColumnTypes="s_name VARCHAR(60)", batch_rows=1)
            raise RuntimeError("the database took texts that are too long")
        except Exception as failure:
            if "took texts" in str(failure):
                raise
        steps = [("after a failed load", landed(read_table(spark, database, name)))]
        load_table(renamed.filter("s_nationkey <> 3"), database, name, content=True)
        steps.append(("after the load", landed(read_table(spark, database, name))))
    finally:
        drop_tables(spark, database, [name])
    parts = [df.select(F.lit(step).alias("step"), "s_suppkey", "s_name", "s_acctbal") for step, df in steps]
    return parts[0].unionByName(parts[1])


@registered(
    """SELECT 'missing' AS difference, 1::BIGINT AS times, o_orderkey, o_totalprice FROM orders
       WHERE o_orderkey % 97 = 0
       UNION ALL SELECT 'extra', 2, -o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 89 = 1
       UNION ALL SELECT 'changed_from', 1, o_orderkey, o_totalprice FROM orders
       WHERE o_orderkey % 83 = 2 AND o_orderkey % 97 <> 0
       UNION ALL SELECT 'changed_to', 1, o_orderkey, o_totalprice + 1 FROM orders
       WHERE o_orderkey % 83 = 2 AND o_orderkey % 97 <> 0
       UNION ALL SELECT 'extra', 1, o_orderkey, o_totalprice FROM orders
       WHERE o_orderkey % 79 = 3 AND o_orderkey % 97 <> 0 AND o_orderkey % 83 <> 2"""
)
def reconcile_rows(spark, sf_dir):
    # Planted: rows that are gone, strange, changed, or there once too often.
    orders = open_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    key = F.col("o_orderkey")
    changed = F.when(key % 83 == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    found = orders.filter(key % 97 != 0).withColumn("o_totalprice", changed)
    strange = orders.filter(key % 89 == 1).withColumn("o_orderkey", -key)
    doubled = orders.filter((key % 79 == 3) & (key % 97 != 0) & (key % 83 != 2))
    found = reduce(DataFrame.unionByName, [found, strange, strange, doubled])
    return differences(landed(orders), landed(found), ["o_orderkey"])


# --- CSV and Parquet files ---------------------------------------------------


@registered("SELECT COLUMNS(*)::VARCHAR FROM part")
def csv_scan_strings(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    write_csv(open_table(spark, sf_dir, "part"), path)
    return read_csv(spark, path)


@registered(
    f"""SELECT c_custkey::INT AS c_custkey, c_name, c_nationkey::INT AS c_nationkey,
               c_acctbal::DOUBLE AS c_acctbal, c_mktsegment,
               strftime(DATE '1950-01-01' + c_nationkey * 365, '%Y-%m-%d') AS c_since,
               'int,double,date' AS inferred FROM customer"""
)
def csv_scan_inferred(spark, sf_dir):
    since = F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 365)
    path = scratch_dir(spark, "csv")
    write_csv(open_table(spark, sf_dir, "customer").withColumn("c_since", since), path)
    read = read_csv(spark, path, infer=True)
    types = [read.schema[c].dataType.simpleString() for c in ("c_custkey", "c_acctbal", "c_since")]
    return with_constants(read, inferred=",".join(types)).withColumn("c_since", day_text("c_since"))


@registered(
    f"""SELECT c_custkey::INT AS c_custkey, c_name, c_nationkey::INT AS c_nationkey,
               c_acctbal::DOUBLE AS c_acctbal, c_mktsegment,
               strftime(DATE '1950-01-01' + c_nationkey * 365, '%Y-%m-%d') AS c_since,
               'int,double,date' AS inferred FROM customer"""
)
def csv_inferred_once(spark, sf_dir):
    since = F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 365)
    path = scratch_dir(spark, "csv")
    write_csv(open_table(spark, sf_dir, "customer").withColumn("c_since", since), path)
    read = read_csv_inferred(spark, path)
    types = [read.schema[c].dataType.simpleString() for c in ("c_custkey", "c_acctbal", "c_since")]
    return with_constants(read, inferred=",".join(types)).withColumn("c_since", day_text("c_since"))


@registered(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 3 < 2 THEN s_name END AS s_name, s_acctbal,
              CASE WHEN s_suppkey % 3 = 1 THEN s_nationkey::VARCHAR END AS s_nationkey FROM supplier"""
)
def csv_by_name(spark, sf_dir):
    # Three kinds of files in one folder: another order, one column more, one column less.
    suppliers = open_table(spark, sf_dir, "supplier")
    headers = [("s_suppkey", "s_name", "s_acctbal"), ("s_nationkey", "s_acctbal", "s_name", "s_suppkey"), ("s_suppkey", "s_acctbal")]
    folder = scratch_dir(spark, "csv")
    for i, columns in enumerate(headers):
        write_csv(suppliers.filter(F.col("s_suppkey") % 3 == i).select(*columns), f"{folder}/part={i}")
    schema = "s_suppkey long, s_name string, s_acctbal double"
    return read_csv_by_name(spark, folder, schema, pattern="*/*.csv")


@registered(
    """SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 OR p_partkey % 53 = 1 THEN 'malformed'
              WHEN p_partkey % 59 = 2 THEN 'missing p_brand' END AS reason,
              CASE WHEN p_partkey % 50 <> 0 AND p_partkey % 53 <> 1 THEN p_size END AS p_size,
              CASE WHEN p_partkey % 50 = 0 THEN p_partkey || ',' || p_brand || ',many'
              WHEN p_partkey % 53 = 1 THEN p_partkey || ',' || p_brand || ',' || p_size || ',more' END AS bad_row
       FROM part"""
)
def csv_quarantine(spark, sf_dir):
    # Planted: sizes that are no numbers, rows with a value too many, rows without a brand.
    key, columns = F.col("p_partkey"), [F.col("p_brand"), F.col("p_size").cast("string")]
    brand = F.when((key % 59 == 2) & (key % 50 != 0) & (key % 53 != 1), F.lit("")).otherwise(columns[0])
    size = F.when(key % 50 == 0, F.lit("many")).otherwise(columns[1])
    more = F.when((key % 53 == 1) & (key % 50 != 0), F.lit(",more")).otherwise(F.lit(""))
    part = open_table(spark, sf_dir, "part")
    path, apart = scratch_dir(spark, "csv"), scratch_dir(spark, "apart")
    lines = part.select(F.concat(F.concat_ws(",", key.cast("string"), brand, size), more).alias("value"))
    lines.write.text(path)
    schema = T.StructType.fromDDL("p_partkey long, p_brand string, p_size int")
    read = read_csv_tolerant(spark, path, schema, header="false")
    write_apart(read, apart, required=["p_partkey", "p_brand"], max_bad_share=0.1)
    good = good_rows(spark, apart, schema).select("p_partkey", F.lit(None).cast("string").alias("reason"), "p_size", F.lit(None).cast("string").alias("bad_row"))
    bad = bad_rows(spark, apart, schema)
    number = F.substring_index("_bad_row", ",", 1).cast("long")
    bad = bad.select(
        F.coalesce(number, "p_partkey").alias("p_partkey"), F.col("_reason").alias("reason"),
        F.when(F.col("_reason") != "malformed", F.col("p_size")).alias("p_size"), F.col("_bad_row").alias("bad_row"),
    )
    return good.unionByName(bad)


@registered(
    """SELECT event_id, CASE WHEN event_id % 40 = 0 THEN 'malformed' END AS reason,
              CASE WHEN event_id % 40 <> 0 THEN event_type END AS event_type FROM events"""
)
def json_quarantine(spark, sf_dir):
    # Planted: lines that are cut off, whose numbers are found in their text.
    events = open_table(spark, sf_dir, "events")
    whole = F.to_json(F.struct("event_id", "event_type"))
    path, apart = scratch_dir(spark, "json"), scratch_dir(spark, "apart")
    cut = F.when(F.col("event_id") % 40 == 0, F.substring_index(whole, "}", 1)).otherwise(whole)
    events.select(cut.alias("value")).write.text(path)
    schema = T.StructType.fromDDL("event_id long, event_type string")
    write_apart(read_json_tolerant(spark, path, schema), apart, max_bad_share=0.05)
    good = good_rows(spark, apart, schema).select("event_id", F.lit(None).cast("string").alias("reason"), "event_type")
    bad = bad_rows(spark, apart, schema)
    number = F.regexp_extract("_bad_row", r'"event_id":(\d+)', 1).cast("long")
    return good.unionByName(bad.select(number.alias("event_id"), F.col("_reason").alias("reason"), F.lit(None).cast("string").alias("event_type")))


@registered(
    """SELECT s_suppkey::INT AS s_suppkey, s_name, s_nationkey::INT AS s_nationkey, s_acctbal
       FROM supplier"""
)
def csv_glob_scan(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    write_csv(open_table(spark, sf_dir, "supplier"), path)
    return read_csv_folder(spark, path)


@registered("SELECT * FROM events")
def csv_lossless_scan(spark, sf_dir):
    # props is JSON: quotes inside values. ts has microseconds.
    path = scratch_dir(spark, "csv")
    events = open_table(spark, sf_dir, "events")
    write_csv(events, path, LOSSLESS)
    return read_csv(spark, path, events.schema, dialect=LOSSLESS)


@registered("SELECT * FROM documents")
def csv_lossless_text(spark, sf_dir):
    # Whole texts: line breaks, separators and quotes inside values.
    path = scratch_dir(spark, "csv")
    texts = open_table(spark, sf_dir, "documents")
    write_csv(texts, path, LOSSLESS)
    return read_csv(spark, path, texts.schema, dialect=LOSSLESS)


@registered(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
              l_discount, l_tax, l_returnflag, l_linestatus,
              strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem"""
)
def parquet_roundtrip(spark, sf_dir):
    folder = scratch_dir(spark, "convert")
    write_csv(open_table(spark, sf_dir, "lineitem"), f"{folder}/csv")
    copy = parquet_copy.run(spark, f"{folder}/csv", f"{folder}/parquet")
    storage.remove(spark, f"{folder}/csv")
    return copy.withColumn("l_shipdate", day_text("l_shipdate"))


@registered(
    "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS same_checksum FROM lineitem"
)
def verify_counts(spark, sf_dir):
    path = scratch_dir(spark, "verify")
    written = write_parquet(open_table(spark, sf_dir, "lineitem"), path, checksum=True)
    found = fingerprint(read_parquet(spark, path))
    return found.select(
        F.lit(written.rows).cast("long").alias("source_rows"),
        F.col("rows").alias("target_rows"),
        (F.col("checksum").cast("string") == str(written.checksum)).alias("same_checksum"),
    )


# --- nested documents --------------------------------------------------------


def race_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a race document with 0 to 4 results."""
    text = lambda column: F.col(column).cast("string")
    month = F.month("o_orderdate").cast("string")
    # every other document gives its round as text
    number = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit('"'), month, F.lit('"')))
    count = F.substring("o_orderpriority", 1, 1).cast("int") - 1

    def result(i: Column) -> Column:
        place = i.cast("string")
        return F.struct(
            F.struct(
                F.concat(F.lit("d"), place).alias("driverId"),
                F.lit("José").alias("name"),
                F.concat(F.lit("Núñez "), place).alias("surname"),
            ).alias("driver"),
            F.struct(
                F.col("o_orderstatus").alias("teamId"),
                F.concat(F.lit("Team "), F.col("o_orderstatus")).alias("teamName"),
            ).alias("team"),
            i.alias("position"),
            place.alias("grid"),
            F.col("o_totalprice").alias("points"),
            F.when(i != 2, F.concat(F.lit("1:0"), place)).alias("time"),
            F.when(i == 1, F.lit("")).otherwise(F.concat(F.lit("0:5"), place)).alias("fastLap"),
            F.when(i == 4, F.lit("DNF")).alias("retired"),
        )

    return open_table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("season"),
        F.struct(
            F.concat(F.lit("race_"), text("o_orderkey")).alias("raceId"),
            F.col("o_orderpriority").alias("raceName"),
            F.parse_json(number.otherwise(month)).alias("round"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.struct(
                text("o_custkey").alias("circuitId"),
                F.concat(F.lit("Circuit "), text("o_custkey")).alias("circuitName"),
            ).alias("circuit"),
            F.slice(F.array(*[result(F.lit(i)) for i in range(1, 5)]), F.lit(1), count).alias(
                "results"
            ),
        ).alias("races"),
    )


def landed_race_documents(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "races")
    files = compressed("gzip", 100_000)  # so many documents in a file
    race_documents(spark, sf_dir).write.options(ignoreNullFields="false", **files).json(path)
    return path


RACE_SQL = """
    SELECT 'race_' || o_orderkey AS race_id, o_orderpriority AS race_name,
           year(o_orderdate) AS race_season, month(o_orderdate) AS race_round,
           strftime(o_orderdate, '%Y-%m-%d') AS race_date,
           o_custkey::VARCHAR AS circuit_id, 'Circuit ' || o_custkey AS circuit_name,
           'd' || i AS driver_id, 'José Núñez ' || i AS driver_name,
           o_orderstatus AS team_id, 'Team ' || o_orderstatus AS team_name,
           i::VARCHAR AS position, i::VARCHAR AS grid_position, o_totalprice AS points,
           CASE WHEN i <> 2 THEN '1:0' || i END AS time,
           CASE WHEN i <> 1 THEN '0:5' || i END AS fastest_lap_time,
           CASE WHEN i = 4 THEN 'DNF' END AS retired
    FROM orders, (VALUES (1), (2), (3), (4)) r(i)
    WHERE i < substr(o_orderpriority, 1, 1)::INT
"""


@registered(RACE_SQL)
def nested_flatten(spark, sf_dir):
    path = landed_race_documents(spark, sf_dir)
    documents = read_json_documents(spark, path, races.DOCUMENT, multi_line=False)
    return races.typed(races.flatten(documents))


@registered(
    f"""SELECT *, '20260306' AS load_date FROM ({RACE_SQL})
        UNION ALL SELECT *, '20260307' AS load_date FROM ({RACE_SQL})"""
)
def race_results_by_date(spark, sf_dir):
    path = landed_race_documents(spark, sf_dir)
    output = scratch_dir(spark, "race-results")
    # compressed documents are a tenth of their text: a task gets fewer bytes of them
    with session_setting(spark, "spark.sql.files.maxPartitionBytes", "16m"):
        for run_date in ("2026-03-07", "2026-03-08"):
            races.run(spark, path, output, run_date, multi_line=False, compression="gzip")
    storage.remove(spark, path)
    return races.read_results(spark, output)


MANIFEST_SQL = """
    SELECT split_part(url, '/', -1) AS name, max_by(url, page_id) AS url FROM pages
    WHERE regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') AND split_part(url, '/', -1) <> ''
    GROUP BY ALL
"""


@registered(MANIFEST_SQL)
def last_write_wins(spark, sf_dir):
    return launches.manifest(page_images(spark, sf_dir))


@registered(MANIFEST_SQL)
def image_manifest(spark, sf_dir):
    # File names and lines both follow page_id.
    path, output = scratch_dir(spark, "launches"), scratch_dir(spark, "manifest")
    pages = page_documents(spark, sf_dir)
    ordered = pages.repartitionByRange("page_id").sortWithinPartitions("page_id")
    ordered.write.option("ignoreNullFields", "false").json(path)
    launches.run(spark, path, output, multi_line=False)
    return read_parquet(spark, f"{output}/manifest").select("name", "url")


@registered(
    """SELECT split_part(url, '/', -1) AS name,
              max_by(CASE WHEN page_id % 3 = 0 THEN 'http://second/' || split_part(url, '/', -1) ELSE url END,
                     CASE WHEN page_id % 3 = 0 THEN 1000000000000 ELSE 0 END + page_id) AS url
       FROM pages WHERE regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') AND split_part(url, '/', -1) <> ''
       GROUP BY ALL"""
)
def manifest_over_runs(spark, sf_dir):
    # Two runs: the second names the files of a third of the pages again, at another place.
    output = scratch_dir(spark, "manifest")
    pages = open_table(spark, sf_dir, "pages")
    again = pages.filter("page_id % 3 = 0").withColumn("url", F.concat(F.lit("http://second/"), last_segment("url")))
    for rows in (pages, again):
        path = scratch_dir(spark, "launches")
        documents = rows.select("page_id", F.array(F.struct(F.col("url").alias("image"))).alias("results"))
        ordered = documents.repartitionByRange("page_id").sortWithinPartitions("page_id")
        ordered.write.option("ignoreNullFields", "false").json(path)
        launches.run(spark, path, output, multi_line=False)
    return read_parquet(spark, f"{output}/manifest").select("name", "url")


@registered("SELECT count(DISTINCT NULLIF(split_part(url, '/', -1), '')) AS files FROM pages")
def distinct_files(spark, sf_dir):
    return launches.file_count(page_images(spark, sf_dir))


@registered(
    """SELECT page_id AS document, pos, CASE pos WHEN 0 THEN url WHEN 1 THEN substr(url, 9)
              WHEN 2 THEN url || '/' END AS url,
              CASE pos WHEN 0 THEN NULLIF(split_part(url, '/', -1), '')
              WHEN 1 THEN NULLIF(split_part(substr(url, 9), '/', -1), '') END AS name,
              pos = 0 AND split_part(url, '/', -1) <> '' AS valid
       FROM pages, (VALUES (0), (1), (2), (3)) r(pos)"""
)
def image_listing(spark, sf_dir):
    return page_images(spark, sf_dir)


def page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as a launch document with four images, three of them unusable."""
    launch = lambda image: F.struct(image.alias("image"))
    url = F.col("url")
    return open_table(spark, sf_dir, "pages").select(
        "page_id",
        F.array(
            launch(url),
            launch(F.substring(url, 9, 2**31 - 1)),
            launch(F.concat(url, F.lit("/"))),
            launch(F.lit(None).cast("string")),
        ).alias("results"),
    )


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images of :func:`page_documents`, from landed documents."""
    path = scratch_dir(spark, "launches")
    page_documents(spark, sf_dir).write.option("ignoreNullFields", "false").json(path)
    schema = T.StructType([*struct_of(page_id=T.LongType()).fields, *launches.DOCUMENT.fields])
    documents = read_json_documents(spark, path, schema, multi_line=False)
    return launches.list_images(documents, "page_id")


# --- output by load date -----------------------------------------------------

DATED = struct_of(
    o_orderkey=T.LongType(), o_orderstatus=T.StringType(), o_totalprice=T.DoubleType()
)


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_table(spark, sf_dir, "orders").select(
        *DATED.fieldNames(),
        F.date_format(F.trunc("o_orderdate", "year"), "yyyyMMdd").alias("load_date"),
    )


DATED_SQL = """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           strftime(date_trunc('year', o_orderdate), '%Y%m%d') AS load_date FROM orders
"""


@registered(
    f"""SELECT o_orderkey, o_totalprice, load_date,
               CASE load_date WHEN '19970101' THEN 'corrected' ELSE o_orderstatus END
               AS o_orderstatus FROM ({DATED_SQL})"""
)
def dated_overwrite(spark, sf_dir):
    path = scratch_dir(spark, "dated")
    orders = dated_orders(spark, sf_dir)
    replace_load_dates(orders, path, rebalance=True)
    corrected = orders.filter("load_date = '19970101'")
    replace_load_dates(
        corrected.withColumn("o_orderstatus", F.lit("corrected")), path, dates=["19970101"]
    )
    return read_load_dates(spark, path, DATED)


@registered(
    f"""SELECT load_date, count(*) AS rows, 1::BIGINT AS files, min(size) + 1 <= sum(size + 1) AS sized,
               CAST(sum(size + 1) AS BIGINT) AS bytes, CAST(sum(size + 1) AS BIGINT) AS smallest
        FROM (SELECT load_date, strlen('{{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}}') AS size
              FROM ({DATED_SQL})) GROUP BY load_date"""
)
def landed_files_by_date(spark, sf_dir):
    # One file per date; its size is that of its lines. No file is opened to tell.
    path = scratch_dir(spark, "dated")
    orders = dated_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "load_date").coalesce(1)
    replace_load_dates(orders, path)
    files = landed_by_date(spark, path).drop("latest")
    counted = orders.groupBy("load_date").agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(files, "load_date").withColumn("sized", F.col("smallest") <= F.col("bytes"))


@registered(f"SELECT * FROM ({DATED_SQL}) WHERE load_date <> '19980101'")
def drop_dated_files(spark, sf_dir):
    path = scratch_dir(spark, "dated")
    replace_load_dates(dated_orders(spark, sf_dir), path, rebalance=True)
    drop_load_date(spark, path, "19980101")
    return read_load_dates(spark, path, DATED)


@registered(
    f"SELECT * FROM ({DATED_SQL}) WHERE load_date <> '19980101'",
    name="drop_load_date",
)
def drop_load_date_of_table(spark, sf_dir):
    table = f"{new_namespace(spark, 'dated')}.orders"
    orders = dated_orders(spark, sf_dir).hint("rebalance", "load_date")
    orders.write.partitionBy("load_date").saveAsTable(table)
    drop_table_load_date(spark, table, "19980101")
    return read_catalog_table(spark, table).select(*DATED.fieldNames(), "load_date")


# --- catalog tables ----------------------------------------------------------


def new_namespace(spark: SparkSession, label: str) -> str:
    """A namespace of its own, its tables kept under the shared folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    create_namespace(spark, name, f"{session_dir(spark)}/{name}")
    return name


@registered(
    """SELECT p_brand, count(*) AS parts, min(p_size) AS smallest, max(p_retailprice) AS dearest
       FROM part GROUP BY p_brand"""
)
def catalog_replace(spark, sf_dir):
    folder = scratch_dir(spark, "csv")
    write_csv(open_table(spark, sf_dir, "part"), folder)
    table = f"{new_namespace(spark, 'staging')}.parts"
    for _ in range(2):  # create, then replace
        staging.run(spark, folder, table)
    storage.remove(spark, folder)
    return query_catalog(
        spark,
        f"SELECT p_brand, count(*) AS parts, min(p_size) AS smallest,"
        f" max(p_retailprice) AS dearest FROM {table} GROUP BY p_brand",
    )


@contextmanager
def own_catalog_table(spark: SparkSession, name: str) -> Iterator[str]:
    """A table name of its own in a catalog that replaces tables itself, dropped at the end."""
    with jdbc_catalog(spark, working_endpoint(spark, "lakehouse")) as catalog:
        create_namespace(spark, f"{catalog}.haulage_staging")  # stays: not every database drops one
        table = f"{catalog}.haulage_staging.{new_table(name)}"
        try:
            yield table
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


@registered("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def catalog_replace_own(spark, sf_dir):
    suppliers = open_table(spark, sf_dir, "supplier")
    with own_catalog_table(spark, "suppliers") as table:
        replace_table(suppliers.select("s_suppkey", "s_name"), table)
        replace_table(suppliers, table)
        return landed(read_catalog_table(spark, table))


@registered(f"SELECT * FROM ({DATED_SQL}) WHERE load_date <> '19980101'")
def drop_load_date_own(spark, sf_dir):
    # A catalog without row deletes: the other dates are copied and replace the table.
    with own_catalog_table(spark, "orders") as table:
        replace_table(dated_orders(spark, sf_dir), table)
        drop_table_load_date(spark, table, "19980101")
        return landed(read_catalog_table(spark, table))


# --- single steps ------------------------------------------------------------


@registered("SELECT * FROM part WHERE p_brand IN ('Brand#2', 'Brand#17')")
def filter_in_list(spark, sf_dir):
    return keep_in(open_table(spark, sf_dir, "part"), "p_brand", ["Brand#2", "Brand#17"])


@registered("SELECT p_partkey, NULLIF(p_brand, 'Brand#2') || ' ' || p_type AS label FROM part")
def concat_plus(spark, sf_dir):
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#2"))
    label = concat_strict(brand, F.lit(" "), F.col("p_type"))
    return open_table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


@registered(
    """SELECT doc_id, NULLIF(toxic, 0)::VARCHAR AS toxic, NULLIF(quality, 0)::VARCHAR AS quality
       FROM labels""",
    name="falsy_to_null",
)
def falsy_values_to_null(spark, sf_dir):
    labels = open_table(spark, sf_dir, "labels")
    kept = {name: falsy_to_null(name, labels.schema[name].dataType) for name in ("toxic", "quality")}
    return labels.select("doc_id", *[col.cast("string").alias(n) for n, col in kept.items()])


@registered("SELECT page_id, split_part(url, '/', -1) AS name FROM pages")
def url_basename(spark, sf_dir):
    return open_table(spark, sf_dir, "pages").select("page_id", last_segment("url").alias("name"))


@registered(
    """SELECT page_id, regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') AS has_scheme,
              regexp_matches(substr(url, 9), '^[A-Za-z][A-Za-z0-9+.-]*://') AS rest_has_scheme
       FROM pages"""
)
def url_valid(spark, sf_dir):
    return open_table(spark, sf_dir, "pages").select(
        "page_id",
        has_scheme("url").alias("has_scheme"),
        has_scheme(F.expr("substr(url, 9)")).alias("rest_has_scheme"),
    )


@registered(
    """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS load_date,
              strftime(o_orderdate - INTERVAL 1 DAY, '%Y') AS season FROM orders""",
    name="load_date_key",
)
def load_date_keys(spark, sf_dir):
    key = load_date_key("o_orderdate")
    return open_table(spark, sf_dir, "orders").select(
        "o_orderkey", key.alias("load_date"), season_of(key).alias("season")
    )


@registered("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(spark, sf_dir):
    return open_table(spark, sf_dir, "events").select(
        "event_id", json_field("props", "$.k").alias("k")
    )


@registered(
    """SELECT c_custkey, '{"name":"' || c_name || '","segment":' ||
              CASE c_mktsegment WHEN 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END
              || '}' AS record FROM customer"""
)
def json_serialise(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    record = json_text(F.struct(F.col("c_name").alias("name"), segment.alias("segment")))
    return open_table(spark, sf_dir, "customer").select("c_custkey", record.alias("record"))


@registered(
    """SELECT count(*) AS rows, count(*) FILTER (event_id IS NULL) AS missing_event_id,
              count(*) FILTER (event_type = 'error') AS missing_event_type,
              count(*) FILTER (json_extract_string(props, '$.k') IS NULL) AS missing_k FROM events"""
)
def required_fields(spark, sf_dir):
    events = open_table(spark, sf_dir, "events")
    assert_ready(events, ("event_id", "event_type", "props"))
    return missing_counts(
        events,
        {
            "event_id": F.col("event_id"),
            "event_type": F.nullif(F.col("event_type"), F.lit("error")),
            "k": json_field("props", "$.k"),
        },
    )


@registered(
    """SELECT count(*) AS rows, 'p_size: int instead of bigint; p_weight: missing' AS differences FROM part"""
)
def schema_report(spark, sf_dir):
    part = open_table(spark, sf_dir, "part")
    expected = struct_of(p_partkey=T.LongType(), p_size=T.LongType(), p_weight=T.DoubleType())
    return with_constants(row_count(part), differences="; ".join(schema_differences(part.schema, expected)))


@registered("SELECT * FROM part")
def required_columns(spark, sf_dir):
    part = open_table(spark, sf_dir, "part")
    return enforce_required(part, ("p_partkey", "p_brand"), "part")


@registered(
    "SELECT count(*) AS rows FROM lineitem",
    name="row_count",
)
def row_counts(spark, sf_dir):
    return row_count(open_table(spark, sf_dir, "lineitem"))


@registered(
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
       FROM orders ORDER BY o_orderkey LIMIT 5"""
)
def preview_n(spark, sf_dir):
    orders = open_table(spark, sf_dir, "orders")
    first = preview(orders, 5, ["o_orderkey"])
    return first.select("o_orderkey", "o_totalprice", day_text("o_orderdate"))
