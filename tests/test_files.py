from __future__ import annotations

import datetime as dt
import os

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from haulage import storage
from haulage.operators import CheckFailed, take_fingerprint, verify
from haulage.schema import struct_of
from haulage.session import scratch_dir
from haulage.sinks import (
    as_csv_text,
    dated_path,
    drop_load_date,
    replace_load_dates,
    write_csv,
    write_parquet,
)
from haulage.sources.files import MICROSECONDS
from haulage.sources import (
    LOSSLESS,
    PLAIN,
    read_csv,
    read_csv_folder,
    read_json_documents,
    read_load_dates,
    read_parquet,
)

AWKWARD = [
    (1, None),
    (2, ""),
    (3, "  outer  "),
    (4, "two\nlines"),
    (5, 'say "hi"'),
    (6, "a;b,c"),
    (7, "back\\slash"),
    (8, "cr\r\nlf"),
    (9, '"'),
    (10, "\\"),
    (11, "ñandú"),
    (12, '\\"'),
    (13, "\t"),
]


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.characters(codec="utf-8"), max_size=8)), max_size=40))
def test_lossless_csv_gives_any_text_back(spark, texts):
    texts = [None if t == "\\N" else t for t in texts]
    path = scratch_dir(spark, "csv")
    df = spark.createDataFrame(list(enumerate(texts)), "k int, v string").coalesce(1)
    written = write_csv(df, path, LOSSLESS, checksum=True)
    back = read_csv(spark, path, "k int, v string", dialect=LOSSLESS)
    assert rows(back) == rows(df)
    assert written.rows == len(texts)


@pytest.mark.parametrize("separator", [",", ";"])
def test_lossless_csv_gives_every_value_back(spark, separator):
    path = scratch_dir(spark, "csv")
    df = spark.createDataFrame(AWKWARD, "k int, v string")
    dialect = LOSSLESS.with_separator(separator)
    written = write_csv(df, path, dialect, checksum=True)
    back = read_csv(spark, path, dialect=dialect)
    assert rows(back) == sorted([(str(k), v) for k, v in AWKWARD], key=repr)
    verify(written, back, "csv")


def test_plain_csv_follows_spark_defaults(spark):
    path = scratch_dir(spark, "csv")
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  outer  "), (4, "a;b")], "k int, v string")
    written = write_csv(df, path, PLAIN.with_separator(";"), checksum=True)
    back = read_csv(spark, path, dialect=PLAIN.with_separator(";"))
    assert rows(back) == [("1", None), ("2", None), ("3", "outer"), ("4", "a;b")]
    with pytest.raises(CheckFailed):
        verify(written, back, "csv")


def test_a_value_equal_to_the_null_mark_comes_back(spark):
    path = scratch_dir(spark, "csv")
    df = spark.createDataFrame([(1, "\\N"), (2, None), (3, "\\\\N\\n\\s")], "k int, v string")
    written = write_csv(df, path, LOSSLESS, checksum=True)
    back = read_csv(spark, path, dialect=LOSSLESS)
    verify(written, back, "csv")
    assert rows(back) == [("1", "\\N"), ("2", None), ("3", "\\\\N\\n\\s")]


def test_csv_text_equals_the_writer_s_own(spark):
    df = spark.sql(
        "SELECT 1 i, 1.5D d, 1e10D big, 2.50BD x, date'2026-03-07' day, true b,"
        " timestamp'2026-03-07 01:02:03.456' at, timestamp_ntz'2026-03-07 01:02:03.456' nt"
    )
    own, ours = scratch_dir(spark, "csv"), scratch_dir(spark, "csv")
    df.write.options(header=True, **MICROSECONDS).csv(own)
    write_csv(df, ours)
    assert rows(spark.read.text(ours)) == rows(spark.read.text(own))
    assert as_csv_text(df).columns == df.columns


def test_csv_types_are_strings_unless_inferred(spark, tmp_path):
    put(tmp_path, "a.csv", "day,n,x,t\n2024-01-01,1,1.5,a\n2024-01-02,2,2.5,b\n")
    path = str(tmp_path / "a.csv")
    assert {t for _, t in read_csv(spark, path).dtypes} == {"string"}
    inferred = dict(read_csv(spark, path, infer=True).dtypes)
    assert inferred == {"day": "date", "n": "int", "x": "double", "t": "string"}
    declared = read_csv(spark, path, schema="day date, n long, x double, t string")
    assert dict(declared.dtypes)["n"] == "bigint"


def test_csv_scan_reads_only_what_is_asked(spark, tmp_path):
    put(tmp_path, "a.csv", "a,b,c\n1,2,3\n")
    plan = read_csv(spark, str(tmp_path)).select("b")._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<b:string>" in plan.toString()


def test_csv_folder_reads_all_matching_files(spark, tmp_path):
    put(tmp_path, "1.csv", "k,name\n1,a\n")
    put(tmp_path, "2.csv", "k,name\n2,b\n")
    put(tmp_path, "3.txt", "k,name\n3,c\n")
    found = read_csv_folder(spark, str(tmp_path))
    assert found.dtypes == [("k", "int"), ("name", "string")]
    assert rows(found) == [(1, "a"), (2, "b")]


def test_csv_folder_with_reordered_header_fails(spark, tmp_path):
    put(tmp_path, "1.csv", "k,name\n1,a\n")
    put(tmp_path, "2.csv", "name,k\nb,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv_folder(spark, str(tmp_path)).collect()


def test_missing_path_fails(spark, tmp_path):
    absent = str(tmp_path / "absent")
    for read in (read_csv, read_parquet):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read(spark, absent)


def test_malformed_json_fails(spark, tmp_path):
    put(tmp_path, "a.json", '{"k": 1')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json_documents(spark, str(tmp_path), struct_of(k=T.LongType())).collect()


def test_parquet_filter_and_columns_reach_the_scan(spark):
    path = scratch_dir(spark, "parquet")
    df = spark.range(100).select("id", (F.col("id") % 3).alias("v"), F.lit("x").alias("w"))
    written = write_parquet(df, path, checksum=True)
    back = read_parquet(spark, path)
    verify(written, back, "parquet")
    plan = back.filter("v = 1").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(v,1)" in plan and "ReadSchema: struct<id:bigint,v:bigint>" in plan


def test_writes_can_be_repeated(spark):
    df = spark.range(10).withColumn("v", F.lit("x"))
    csv, parquet = scratch_dir(spark, "csv"), scratch_dir(spark, "parquet")
    for _ in range(2):
        write_csv(df, csv)
        write_parquet(df, parquet)
    assert read_csv(spark, csv).count() == read_parquet(spark, parquet).count() == 10


def test_failed_overwrite_keeps_the_old_files(spark, tmp_path):
    broken = spark.range(9).select(
        F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id")
    )
    for write in (write_csv, write_parquet):
        path = str(tmp_path / write.__name__)
        write(spark.range(3), path)
        before = sorted(os.listdir(path))
        with pytest.raises(Exception, match="broken"):
            write(broken, path)
        assert sorted(os.listdir(path)) == before
        write(spark.range(4), path)
    assert sorted(os.listdir(tmp_path)) == ["write_csv", "write_parquet"]
    assert read_csv(spark, str(tmp_path / "write_csv")).count() == 4
    assert read_parquet(spark, str(tmp_path / "write_parquet")).count() == 4


def test_failed_swap_puts_all_folders_back(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / name) for name in ("a", "b")]
    for path in paths:
        write_parquet(spark.range(1), path)
    rename = storage._rename

    def fails_at_last(spark, source, target):
        if target == paths[1] and "_b-" in source and not fails_at_last.done:
            fails_at_last.done = True
            raise OSError("store is away")
        rename(spark, source, target)

    fails_at_last.done = False
    monkeypatch.setattr(storage, "_rename", fails_at_last)
    with pytest.raises(OSError, match="away"):
        with storage.replacing(spark, *paths) as staged:
            for new in staged:
                spark.range(2).write.parquet(new)
    assert [read_parquet(spark, path).count() for path in paths] == [1, 1]
    assert sorted(os.listdir(tmp_path)) == ["a", "b"]


def test_dated_path():
    assert dated_path("/base/", "T", "2026-03-07") == "/base/T_2026-03-07"
    assert dated_path("s3a://b", "T", dt.date(2026, 3, 7)) == "s3a://b/T_2026-03-07"


# --- by load date ---

RECORD = struct_of(k=T.LongType(), v=T.StringType())


def dated(spark, *triples):
    return spark.createDataFrame(list(triples), "k long, v string, load_date string")


def test_rerun_replaces_only_its_dates(spark):
    path = scratch_dir(spark, "dated")
    replace_load_dates(dated(spark, (1, "a", "20260101"), (2, "b", "20260102")), path)
    for _ in range(2):
        done = replace_load_dates(dated(spark, (3, "c", "20260102")), path, dates=["20260102"])
        assert done.rows == 1
    assert rows(read_load_dates(spark, path, RECORD)) == [(1, "a", "20260101"), (3, "c", "20260102")]


def test_rerun_without_rows_empties_its_date(spark):
    path = scratch_dir(spark, "dated")
    both = dated(spark, (1, "a", "20260101"), (2, "b", "20260102"))
    replace_load_dates(both, path)
    replace_load_dates(both.filter("k > 9"), path, dates=["20260102"])
    assert rows(read_load_dates(spark, path, RECORD)) == [(1, "a", "20260101")]


def test_failed_rerun_changes_nothing(spark):
    path = scratch_dir(spark, "dated")
    replace_load_dates(dated(spark, (1, "a", "20260101")), path)
    failing = F.raise_error(F.lit("broken input")).cast("string")
    broken = dated(spark, (2, "b", "20260101")).withColumn("v", failing)
    with pytest.raises(Exception, match="broken input"):
        replace_load_dates(broken, path, dates=["20260101"])
    assert rows(read_load_dates(spark, path, RECORD)) == [(1, "a", "20260101")]


def test_load_date_stays_text_and_prunes_folders(spark):
    path = scratch_dir(spark, "dated")
    replace_load_dates(dated(spark, (1, "a", "00260101"), (2, "b", "20260102")), path)
    found = read_load_dates(spark, path, RECORD)
    assert found.schema["load_date"].dataType == T.StringType()
    one = found.filter("load_date = '00260101'")
    assert rows(one) == [(1, "a", "00260101")]
    assert "PartitionFilters: [isnotnull(load_date" in one._jdf.queryExecution().executedPlan().toString()


def test_json_lines_keep_nulls_and_non_ascii(spark):
    path = scratch_dir(spark, "dated")
    replace_load_dates(dated(spark, (1, "Pérez", "20260101"), (2, None, "20260101")), path)
    lines = rows(spark.read.text(f"{path}/load_date=20260101"))
    assert lines == [('{"k":1,"v":"Pérez"}',), ('{"k":2,"v":null}',)]


def test_rebalance_divides_a_hot_date(spark):
    path = scratch_dir(spark, "dated")
    hot = spark.range(0, 40_000, 1, 8).select(
        "id", F.when(F.col("id") < 39_990, "20260101").otherwise("20260102").alias("load_date")
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "32k")
    try:
        replace_load_dates(hot, path, rebalance=True)
    finally:
        spark.conf.set(key, before)
    files = os.listdir(f"{path.removeprefix('file:')}/load_date=20260101")
    assert len([f for f in files if f.startswith("part-")]) > 1
    found = read_load_dates(spark, path, struct_of(id=T.LongType()))
    assert rows(found.groupBy("load_date").count()) == [("20260101", 39_990), ("20260102", 10)]


def test_drop_load_date(spark):
    path = scratch_dir(spark, "dated")
    replace_load_dates(dated(spark, (1, "a", "20260101"), (2, "b", "20260102")), path)
    assert drop_load_date(spark, path, "20260101") is True
    assert drop_load_date(spark, path, "20260101") is False
    assert rows(read_load_dates(spark, path, RECORD)) == [(2, "b", "20260102")]


def test_storage(spark):
    path = scratch_dir(spark, "storage")
    assert not storage.exists(spark, path)
    spark.range(1).write.parquet(path)
    assert storage.exists(spark, path)
    assert storage.remove(spark, path) and not storage.exists(spark, path)


def test_fingerprint_of_csv_text(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert take_fingerprint(as_csv_text(df)) == take_fingerprint(df.select(F.col("k").cast("string"), "v"))


def test_csv_reads_are_strict(spark, tmp_path):
    def put_csv(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(text)
        return str(tmp_path / name)

    bad_number = put_csv("number", "n,t\n1,a\nabc,b\n")
    extra = put_csv("extra", "n,t\n1,a,surplus\n")
    swapped = put_csv("swapped", "t,n\na,1\n")
    for path in (bad_number, extra, swapped):
        with pytest.raises(Exception):
            read_csv(spark, path, "n int, t string").collect()
    assert read_csv(spark, bad_number, "n int, t string", mode="PERMISSIVE").count() == 2


def test_times_keep_microseconds(spark, tmp_path):
    import datetime as when

    from haulage.sinks import replace_load_dates
    from haulage.sources import LOSSLESS

    moment = when.datetime(2026, 3, 6, 1, 2, 3, 123456)
    df = spark.createDataFrame([(moment, moment, "20260306")], "a timestamp, b timestamp_ntz, load_date string")
    for checksum in (False, True):
        path = str(tmp_path / f"csv{checksum}")
        write_csv(df, path, LOSSLESS, checksum=checksum)
        assert read_csv(spark, path, df.schema, dialect=LOSSLESS).first() == df.first()
    replace_load_dates(df, str(tmp_path / "json"))
    assert spark.read.schema(df.schema).json(str(tmp_path / "json")).first()[:2] == (moment, moment)
