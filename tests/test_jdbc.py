"""JDBC against Derby in memory, which lives in this process only."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from haulage.plans import customer, replicate
from haulage.session import scratch_dir, session_setting
from haulage.sinks import load_table, swap_tables, write_table
from haulage.sources import (
    Bounds,
    Endpoint,
    PLAIN,
    Split,
    count_rows,
    find_tables,
    read_query,
    read_table,
)
from haulage.sources.embedded import working_endpoint
from haulage.sources.jdbc import split_predicates


@pytest.fixture(scope="module")
def database(spark):
    return working_endpoint(spark, f"unit-{uuid.uuid4().hex}")


@pytest.fixture
def table():
    return f"T{uuid.uuid4().hex[:12]}".upper()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_query_runs_in_the_database(spark, database, table):
    write_table(spark.range(10).withColumn("v", F.col("id") % 2), database, table)
    found = read_query(spark, database, f'SELECT "id" AS k FROM {table} WHERE "v" = 1')
    assert [r[0] for r in rows(found)] == [1, 3, 5, 7, 9]
    assert found.rdd.getNumPartitions() == 1


def test_filter_and_columns_reach_the_database(spark, database, table):
    write_table(spark.range(10).withColumn("v", F.col("id") % 2), database, table)
    text = plan(read_table(spark, database, table).filter("v = 1").select("id"))
    assert "PushedFilters: [*IsNotNull(v), *EqualTo(v,1)]" in text
    assert "ReadSchema: struct<id:bigint>" in text


def test_bounds_read(spark, database, table):
    write_table(spark.range(100), database, table)
    found = read_table(spark, database, table, Bounds("id", 0, 100, 4))
    assert found.rdd.getNumPartitions() == 4
    assert found.count() == 100


def test_split_query_read(spark, database, table):
    write_table(spark.range(1000), database, table)
    sql = f'SELECT "id" FROM {table} WHERE "id" >= 100'
    found = read_query(spark, database, sql, Split(("id",), 100))
    assert found.rdd.getNumPartitions() >= 9
    assert [r[0] for r in sorted(found.collect())] == list(range(100, 1000))


def partition_sizes(spark, database, table, split):
    parts = split_predicates(spark, database, table, split)
    sizes = []
    for where in parts:
        sql = f"SELECT COUNT(*) AS n FROM {table} WHERE {where}"
        sizes.append(int(read_query(spark, database, sql).first()[0]))
    return sizes


def test_split_is_even_when_keys_have_gaps(spark, database, table):
    # One key far away: equal strides would put all other rows into one read.
    keys = spark.range(1000).union(spark.sql("SELECT 1000000000000L"))
    write_table(keys, database, table)
    sizes = partition_sizes(spark, database, table, Split(("id",), 100))
    assert sum(sizes) == 1001 and max(sizes) <= 100
    assert len(sizes) <= 24


def test_split_divides_a_hot_value_by_the_next_column(spark, database, table):
    df = spark.range(900).select(
        F.when(F.col("id") < 300, 7).otherwise(F.col("id")).cast("int").alias("k"),
        F.col("id").cast("int").alias("line"),
    )
    write_table(df, database, table)
    alone = partition_sizes(spark, database, table, Split(("k",), 100))
    assert sum(alone) == 900 and max(alone) == 300
    both = partition_sizes(spark, database, table, Split(("k", "line"), 100))
    assert sum(both) == 900 and max(both) <= 100
    found = read_table(spark, database, table, Split(target_rows=100))  # columns found by type
    assert found.rdd.getNumPartitions() == len(both)
    assert rows(found) == rows(df)


def test_split_divides_many_nulls(spark, database, table):
    df = spark.range(600).select(
        F.when(F.col("id") >= 300, F.col("id")).alias("k"), F.col("id").alias("line")
    )
    write_table(df, database, table)
    sizes = partition_sizes(spark, database, table, Split(("k", "line"), 100))
    assert sum(sizes) == 600 and max(sizes) <= 100


def test_split_of_a_small_or_empty_table_is_one_read(spark, database, table):
    write_table(spark.range(0), database, table)
    assert split_predicates(spark, database, table, Split(("id",), 100)) == ["1 = 1"]
    assert read_table(spark, database, table, Split()).count() == 0


def test_timestamps_do_not_depend_on_the_session_time_zone(spark, database, table):
    at = F.lit("2026-03-29 02:30:00").cast("timestamp_ntz")
    with session_setting(spark, "spark.sql.session.timeZone", "Europe/Madrid"):
        write_table(spark.range(1).select(at.alias("at")), database, table)
        found = read_table(spark, database, table)
        assert [str(r[0]) for r in found.collect()] == ["2026-03-29 02:30:00"]
        copy = f"{table}C"
        write_table(found, database, copy)
        assert rows(read_table(spark, database, copy)) == rows(found)


@pytest.mark.parametrize("unit", ["date", "timestamp_ntz"])
def test_split_without_whole_numbers_uses_time(spark, database, table, unit):
    day = F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int"))
    df = spark.range(100).select(
        F.when(F.col("id") > 4, day.cast(unit)).alias("at"), F.col("id").cast("string").alias("v")
    )
    write_table(df, database, table)
    found = read_table(spark, database, table, Split(target_rows=25))
    assert found.rdd.getNumPartitions() == 4
    assert rows(found) == rows(df)
    assert max(partition_sizes(spark, database, table, Split(target_rows=25))) < 30


def test_split_without_whole_numbers_or_time_is_one_read(spark, database, table):
    write_table(spark.createDataFrame([("a",)], "v string"), database, table)
    assert read_table(spark, database, table, Split(target_rows=1)).count() == 1


keys = st.one_of(st.none(), st.integers(-5, 5), st.integers(-(2**62), 2**62))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, st.integers(0, 3)), min_size=1, max_size=40), st.integers(1, 10))
def test_split_covers_every_row_once(spark, database, pairs, target):
    name = f"T{uuid.uuid4().hex[:12]}".upper()
    df = spark.createDataFrame(pairs, "k long, v int").coalesce(1)
    write_table(df, database, name)
    found = read_table(spark, database, name, Split(("k", "v"), target))
    assert rows(found) == rows(df)


def test_find_tables(spark, database):
    names = [f"F{uuid.uuid4().hex[:8]}".upper() for _ in range(3)]
    for name in names[:2]:
        write_table(spark.range(1), database, name)
    found = find_tables(spark, database, names, "APP")
    assert found.columns == ["table_name"]
    assert rows(found) == sorted((n,) for n in names[:2])
    assert "PushedFilters: [*In(TABLENAME" in plan(find_tables(spark, database, names))
    assert rows(find_tables(spark, database, names, "OTHER")) == []


def test_overwrite_replaces_the_table(spark, database, table):
    write_table(spark.range(5), database, table)
    write_table(spark.range(3).withColumn("v", F.lit("x")), database, table)
    assert read_table(spark, database, table).columns == ["id", "v"]
    assert count_rows(spark, database, table) == 3


def test_truncate_keeps_the_definition(spark, database, table):
    df = spark.range(5).select(F.col("id").cast("int").alias("id"))
    write_table(df, database, table, createTableColumnTypes="id DECIMAL(9, 0)")
    write_table(df.limit(2), database, table, truncate=True)
    assert read_table(spark, database, table).dtypes == [("id", "decimal(9,0)")]
    assert count_rows(spark, database, table) == 2


def broken(spark):
    return spark.range(10).select(
        F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("source broke"))).alias("id")
    )


def test_failed_input_leaves_the_loaded_table_alone(spark, database, table):
    load_table(spark.range(5), database, table)
    with pytest.raises(Exception, match="source broke"):
        load_table(broken(spark), database, table)
    assert count_rows(spark, database, table) == 5


def test_load_can_be_repeated(spark, database, table):
    for _ in range(2):
        assert load_table(spark.range(7), database, table) == 7
    assert count_rows(spark, database, table) == 7


def test_wrong_row_count_is_an_error(spark, database, table):
    with pytest.raises(Exception, match="8 rows to load, the table holds 7"):
        load_table(spark.range(7), database, table, landed_rows=8)


def test_endpoint_shows_no_secrets(monkeypatch):
    url = "jdbc:postgresql://host/db?user=me&password=hidden"
    endpoint = Endpoint(url, "me", "hidden")
    assert "hidden" not in repr(endpoint) and "hidden" not in str(endpoint)
    assert "hidden" not in endpoint.redact(f"cannot reach {url} with hidden")
    assert endpoint.redact("x?user=a&password=b;c") == "x?user=***&password=***;c"
    assert endpoint.options() == {
        "url": url,
        "driver": "org.postgresql.Driver",
        "user": "me",
        "password": "hidden",
    }
    monkeypatch.setenv("SRC_JDBC_URL", url)
    monkeypatch.setenv("SRC_PASSWORD", "hidden")
    assert Endpoint.from_env("SRC") == Endpoint(url, None, "hidden")
    with pytest.raises(ValueError, match="NONE_JDBC_URL is not set"):
        Endpoint.from_env("NONE")


# --- replication ---


def test_replicate_reports_each_table(spark):
    source = working_endpoint(spark, f"from-{uuid.uuid4().hex}")
    target = working_endpoint(spark, f"to-{uuid.uuid4().hex}")
    write_table(spark.range(100).withColumn("v", F.lit("x")), source, "FILLED")
    write_table(spark.range(0), source, "VOID")
    # A target table that cannot be dropped: another one refers to it.
    write_table(spark.range(3), source, "HELD")
    write_table(spark.range(1), target, "SRC_HELD_KEEPER")
    execute(spark, target, 'CREATE TABLE src_HELD ("id" BIGINT NOT NULL PRIMARY KEY)')
    execute(spark, target, 'CREATE TABLE refers ("id" BIGINT REFERENCES src_HELD("id"))')
    names = ["FILLED", "HELD", "VOID", "NOWHERE", "FILLED"]
    for _ in range(2):
        report = replicate.run(spark, source, target, names, schema="APP")
        found = {r.table_name: r for r in report.collect()}
        assert report.columns == ["table_name", "status", "source_rows", "target_rows", "error"]
        assert len(found) == report.count() == 4
        assert found["FILLED"][1:4] == ("loaded", 100, 100)
        assert found["VOID"][1:4] == ("loaded", 0, 0)
        assert found["NOWHERE"].status == "missing"
        assert found["HELD"].status == "failed" and "refer to it" in found["HELD"].error
        assert count_rows(spark, target, "src_HELD") == 0 and count_rows(spark, target, "refers") == 0
        left = [name for (name,) in tables_of(spark, target) if name.startswith("HAULAGE")]
        assert not left
        assert "memory:" not in found["HELD"].error
    assert rows(read_table(spark, target, "src_FILLED")) == rows(read_table(spark, source, "FILLED"))


def test_decimal_keys_are_split(spark, database, table):
    keys = spark.range(1000).select(F.col("id").cast("decimal(18,0)").alias("k"), F.lit("x").alias("v"))
    write_table(keys, database, table)
    sizes = partition_sizes(spark, database, table, Split(target_rows=100))
    assert sum(sizes) == 1000 and max(sizes) <= 100


# --- splits by other keys, and skew ---


def test_text_keys_are_split(spark, database, table):
    keys = spark.range(1000).select(F.format_string("Key 'O''%06d", "id").alias("k"))
    write_table(keys, database, table)
    sizes = partition_sizes(spark, database, table, Split(target_rows=100))
    assert sum(sizes) == 1000 and max(sizes) <= 100
    assert rows(read_table(spark, database, table, Split(target_rows=100))) == rows(keys)


def test_long_decimal_keys_are_split(spark, database, table):
    big = F.lit("1234567890123456789012345").cast("decimal(30,0)")
    keys = spark.range(1000).select((big + F.col("id").cast("decimal(30,0)")).cast("decimal(30,0)").alias("k"))
    write_table(keys, database, table)
    sizes = partition_sizes(spark, database, table, Split(target_rows=100))
    assert sum(sizes) == 1000 and max(sizes) <= 100


@pytest.mark.parametrize("other", ["text", "money", "time"])
def test_a_hot_key_is_divided_by_any_later_column(spark, database, table, other):
    value = {
        "text": F.md5(F.col("id").cast("string")),
        "money": (F.col("id") / 7).cast("decimal(12,2)"),
        "time": F.timestamp_seconds(F.col("id") * 0.01).cast("timestamp_ntz"),
    }[other]
    df = spark.range(2000).select(F.lit(1).alias("k"), value.alias("v"))
    write_table(df, database, table)
    sizes = partition_sizes(spark, database, table, Split(target_rows=200))
    assert sum(sizes) == 2000 and max(sizes) <= 400
    assert rows(read_table(spark, database, table, Split(target_rows=200))) == rows(df)


def test_counted_times_follow_the_rows(spark, database, table):
    # Nine tenths of the rows on one timestamp, a tenth without one.
    start = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    at = F.when(F.col("id") < 1600, start).when(F.col("id") < 1800, start + F.expr("make_dt_interval(0, 0, 0, id)"))
    df = spark.range(2000).select(at.alias("at"), F.col("id").cast("string").alias("v"))
    write_table(df, database, table)
    sizes = partition_sizes(spark, database, table, Split(target_rows=100))
    assert sum(sizes) == 2000 and max(sizes) <= 200


def test_many_clusters_take_few_planning_queries(spark, database, table, monkeypatch):
    keys = spark.range(4000).select(((F.col("id") % 200) * 1_000_000_000_000 + F.col("id")).alias("k"))
    write_table(keys, database, table)
    asked = []

    def counting(spark, endpoint, sql, *args, **options):
        asked.append(sql)
        return read_query(spark, endpoint, sql, *args, **options)

    monkeypatch.setattr("haulage.sources.jdbc.read_query", counting)
    parts = split_predicates(spark, database, table, Split(target_rows=10))
    assert len(asked) <= 6
    assert 400 <= len(parts) <= 1000
    monkeypatch.undo()
    cases = " ".join(f"WHEN {where} THEN {i}" for i, where in enumerate(parts[:150]))
    sql = f"SELECT b, COUNT(*) AS n FROM (SELECT CASE {cases} ELSE -1 END AS b FROM {table}) x WHERE b >= 0 GROUP BY b"
    assert max(r.N if hasattr(r, "N") else r[1] for r in read_query(spark, database, sql).collect()) <= 20


texts = st.one_of(st.none(), st.text("aAb' %_é", max_size=4))
moments = st.one_of(st.none(), st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1)), st.integers(0, 9).map(lambda n: dt.datetime(2026, 1, 1, microsecond=n)))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(texts, moments), min_size=1, max_size=40), st.integers(1, 10), st.booleans())
def test_split_by_texts_and_times_covers_every_row_once(spark, database, pairs, target, text_first):
    name = f"T{uuid.uuid4().hex[:12]}".upper()
    df = spark.createDataFrame(pairs, "k string, v timestamp_ntz").coalesce(1)
    write_table(df, database, name)
    columns = ("k", "v") if text_first else ("v", "k")
    found = read_table(spark, database, name, Split(columns, target))
    assert rows(found) == rows(df)


def test_number_of_reads_is_bounded(spark, database, table):
    write_table(spark.range(1000), database, table)
    assert len(split_predicates(spark, database, table, Split(target_rows=1, max_reads=10))) <= 21


def test_equal_rows_stay_one_read(spark, database, table):
    write_table(spark.range(50).select(F.lit(1).alias("k"), F.lit("x").alias("v")), database, table)
    found = read_table(spark, database, table, Split(target_rows=10))
    assert found.count() == 50


def execute(spark, endpoint, sql):
    connection = spark._jvm.java.sql.DriverManager.getConnection(endpoint.url)
    try:
        connection.createStatement().execute(sql)
    finally:
        connection.close()

# --- swap and content ---


@pytest.mark.parametrize("quoted_name", [False, True])
def test_load_that_breaks_in_the_database_leaves_old_rows(spark, database, table, quoted_name):
    name = f'"mixed-Case {table}"' if quoted_name else f"mixed_{table}"
    old = spark.range(5).select("id", F.lit("old").alias("v"))
    assert load_table(old, database, name) == 5
    bad = spark.range(100).select("id", F.when(F.col("id") < 99, "new").otherwise("much too long").alias("v")).coalesce(1)
    before = tables_of(spark, database)
    with pytest.raises(Exception, match="22001|too long|truncat"):
        load_table(bad, database, name, createTableColumnTypes="v VARCHAR(5)", batch_rows=10)
    assert rows(read_table(spark, database, name)) == rows(old)
    assert tables_of(spark, database) == before  # nothing is left beside it
    assert load_table(bad.limit(50), database, name, content=True) == 50
    assert count_rows(spark, database, name) == 50
    assert tables_of(spark, database) == before


def tables_of(spark, database):
    found = read_query(spark, database, "SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'")
    return rows(found)


def test_load_into_another_schema(spark, database, table):
    execute(spark, database, f'CREATE SCHEMA "s {table}"')
    name = f'"s {table}".t'
    for n in (3, 4):
        assert load_table(spark.range(n), database, name, content=True) == n
    assert count_rows(spark, database, name) == 4


def test_load_into_a_schema_without_quotes(spark, database, table):
    name = f"app.mixed_{table}"
    for n in (3, 4):
        assert load_table(spark.range(n), database, name) == n
    assert count_rows(spark, database, f"APP.MIXED_{table}") == 4
    with pytest.raises(Exception, match="no table app.nowhere to take the place"):
        swap_tables(spark, database, "app.nowhere", name)


def test_failed_second_rename_takes_the_first_back(spark, database, table, monkeypatch):
    load_table(spark.range(5), database, table)
    write_table(spark.range(9), database, f"{table}_new")
    real = spark.sql

    def breaks(text, *args, **options):
        if "RENAME" in text and text.endswith(f"RENAME TO `{table}`") and f"`{table}_NEW`" in text:
            raise RuntimeError("connection lost")
        return real(text, *args, **options)

    monkeypatch.setattr(spark, "sql", breaks)
    with pytest.raises(RuntimeError, match="connection lost"):
        swap_tables(spark, database, f"{table}_new", table)
    monkeypatch.undo()
    assert count_rows(spark, database, table) == 5
    swap_tables(spark, database, f"{table}_new", table)
    assert count_rows(spark, database, table) == 9


def test_truncating_load_keeps_the_definition(spark, database, table):
    write_table(spark.range(5), database, table, createTableColumnTypes="id DECIMAL(9, 0)")
    assert load_table(spark.range(3), database, table, truncate=True) == 3
    assert read_table(spark, database, table).dtypes == [("id", "decimal(9,0)")]


def test_wrong_content_is_an_error(spark, database, table):
    load_table(spark.range(5).select("id", F.lit("keep").alias("v")), database, table)
    wide = spark.range(5).select("id", (F.col("id") / 3).cast("decimal(20,10)").alias("v"))
    with pytest.raises(Exception, match="3 rows are missing or different, 3 are not expected"):
        load_table(wide, database, table, content=True, createTableColumnTypes="v DECIMAL(9, 2)")
    assert rows(read_table(spark, database, table).select("v")) == [("keep",)] * 5


def test_replication_reports_wrong_content(spark, monkeypatch):
    source = working_endpoint(spark, f"from-{uuid.uuid4().hex}")
    target = working_endpoint(spark, f"to-{uuid.uuid4().hex}")
    write_table(spark.range(10), source, "GOOD")
    import haulage.sinks.jdbc as sink

    real = sink.write_table
    monkeypatch.setattr(sink, "write_table", lambda df, *a, **k: real(df.withColumn("id", F.col("id") + 1), *a, **k))
    report = replicate.run(spark, source, target, ["GOOD"], schema="APP").first()
    assert report.status == "failed" and "10 rows" not in report.error and "rows are missing or different" in report.error
    assert replicate.run(spark, source, target, ["GOOD"], schema="APP", content=False).first().status == "loaded"


# --- splits that can't divide ---


def test_a_round_without_progress_ends_with_a_warning(spark, database, table, monkeypatch, caplog):
    write_table(spark.range(1000), database, table)
    asked = []

    def whole(self, parts, *_):
        asked.append(len(parts))
        assert len(asked) < 5, "no end"
        return [(i, 0, 0, 999, part.rows) for i, part in enumerate(parts)]

    monkeypatch.setattr("haulage.sources.jdbc._Counts.grouped", whole)
    parts = split_predicates(spark, database, table, Split(("id",), 100))
    assert parts == ['1 = 1 AND "id" IS NULL', '1 = 1 AND "id" IS NOT NULL'] and "can't be divided" in caplog.text


def test_times_are_compared_not_subtracted(spark, database, table, monkeypatch):
    micros = F.timestamp_micros(F.col("id")).cast("timestamp_ntz")
    write_table(spark.range(2000).select(micros.alias("at"), F.lit("x").alias("v")), database, table)
    asked = []

    def watched(spark, endpoint, sql, *args, **options):
        asked.append(sql)
        return read_query(spark, endpoint, sql, *args, **options)

    monkeypatch.setattr("haulage.sources.jdbc.read_query", watched)
    sizes_target = Split(("at",), 100)
    parts = split_predicates(spark, database, table, sizes_target)
    monkeypatch.undo()
    assert not any("TIMESTAMPDIFF" in sql for sql in asked) and len(asked) <= 5
    sizes = partition_sizes(spark, database, table, sizes_target)
    assert len(parts) >= 20 and sum(sizes) == 2000 and max(sizes) <= 125


def test_times_at_the_end_of_time(spark, database, table):
    far = F.when(F.col("id") < 500, F.lit("0001-01-01 00:00:00")).otherwise(F.lit("9999-12-31 23:59:59.999999")).cast("timestamp_ntz")
    write_table(spark.range(1000).select(far.alias("at"), "id"), database, table)
    sizes = partition_sizes(spark, database, table, Split(("at", "id"), 100))
    assert sum(sizes) == 1000 and max(sizes) <= 125


# --- customer dimension ---

CUSTOMERS = [
    (1, "Ann", "Lee", "1990-01-02", "F", "ann@x", "extra"),
    (2, None, "Ray", None, "M", "ray@x", "extra"),
    (3, "Bo;b", 'O"Neil', "1980-05-06", "m", "", "extra"),
    (4, "Cy", None, "1970-07-08", None, None, "extra"),
    (5, "", " Day ", "1960-09-10", "X", "day\n@x", "extra"),
    (6, None, None, "1950-11-12", "F", "six@x", "extra"),
]

EXPECTED = [
    ("1", "Ann", "Lee", "Ann, Lee", "1990-01-02", "Female", "ann@x"),
    ("2", None, "Ray", "Ray", None, "Male", "ray@x"),
    ("3", "Bo;b", 'O"Neil', 'Bo;b, O"Neil', "1980-05-06", "Unknown", ""),
    ("5", "", " Day ", ",  Day ", "1960-09-10", "Unknown", "day\n@x"),
    ("6", None, None, "", "1950-11-12", "Female", "six@x"),
]


def customer_table(spark, endpoint, name):
    schema = (
        "CustomerKey int, FirstName string, LastName string, BirthDate string,"
        " Gender string, EmailAddress string, Title string"
    )
    df = spark.createDataFrame(CUSTOMERS, schema)
    write_table(df.withColumn("BirthDate", F.col("BirthDate").cast("date")), endpoint, name)


def test_customer_pipeline(spark, database, table):
    customer_table(spark, database, table)
    base = scratch_dir(spark, "customer")
    for _ in range(2):
        done = customer.run(
            spark, database, database, base, "2026-03-07", table, f"stg_{table}"
        )
        assert done.csv_path == f"{base}/{table}_2026-03-07"
        assert done.csv.rows == done.staged_rows == 5
    staged = read_table(spark, database, f"stg_{table}")
    assert {t for _, t in staged.dtypes} == {"string"}
    assert tuple(staged.columns) == customer.OUTPUT_COLUMNS
    wanted = [r + ("AdventureWorks", "2026-03-07") for r in EXPECTED]
    assert rows(staged) == sorted(wanted, key=repr)


def test_customer_staging_can_be_typed(spark, database, table):
    customer_table(spark, database, table)
    schema = ", ".join(
        f"{name} {dict(CustomerKey='int', BirthDate='date').get(name, 'string')}"
        for name in customer.OUTPUT_COLUMNS
    )
    base = scratch_dir(spark, "customer")
    customer.run(
        spark, database, database, base, "2026-03-07", table, f"stg_{table}", schema=schema
    )
    staged = read_table(spark, database, f"stg_{table}")
    assert [t for _, t in staged.dtypes][:5] == ["int", "string", "string", "string", "date"]
    assert staged.count() == 5


def test_customer_pipeline_with_plain_csv(spark, database, table):
    write_table(
        spark.createDataFrame(
            [(1, "A", " L ", None, "F", "")],
            "CustomerKey int, FirstName string, LastName string, BirthDate date,"
            " Gender string, EmailAddress string",
        ),
        database,
        table,
    )
    customer.run(
        spark,
        database,
        database,
        scratch_dir(spark, "customer"),
        "2026-03-07",
        table,
        f"stg_{table}",
        dialect=PLAIN.with_separator(";"),
    )
    staged = read_table(spark, database, f"stg_{table}").first()
    # The e-mail was empty, and the plain dialect reads empty text as null.
    assert (staged.LastName, staged.FullName, staged.EmailAddress) == ("L", "A,  L", None)


def test_customer_source_must_be_ready(spark, database, table):
    write_table(spark.range(1), database, table)
    with pytest.raises(Exception, match="EmailAddress: missing"):
        customer.run(
            spark, database, database, scratch_dir(spark, "c"), "2026-03-07", table, f"stg_{table}"
        )


def test_conform_is_one_stage_and_pushes_its_filter(spark, database, table):
    customer_table(spark, database, table)
    text = plan(customer.conform(read_table(spark, database, table), "2026-03-07"))
    assert "Exchange" not in text
    assert "*IsNotNull(EmailAddress)" in text
    assert "Title" not in text.split("ReadSchema")[1]
