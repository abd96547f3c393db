from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from haulage.operators import (
    CheckFailed,
    Fingerprint,
    assert_ready,
    enforce_required,
    explode_records,
    field_of_each,
    fingerprint,
    keep_in,
    keep_present,
    last_write_wins,
    distinct_count,
    missing_counts,
    observed_write,
    preview,
    row_count,
    schema_differences,
    take_fingerprint,
    verify,
    with_constants,
)
from haulage.session import scratch_dir


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_keep_present_keeps_empty_text(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "k int, email string")
    assert rows(keep_present(df, "email").select("k")) == [(1,), (2,)]


def test_keep_in_never_matches_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert rows(keep_in(df, "v", ["a", "c"])) == [("a",)]
    assert rows(keep_in(df, "v", [])) == []


def test_with_constants_adds_and_replaces(spark):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    assert rows(with_constants(df, v="y", w="z")) == [(1, "y", "z")]


def test_explode_records_repeats_parents(spark):
    df = spark.createDataFrame(
        [("r1", [("a", 1), ("b", 2)]), ("r2", []), ("r3", None)],
        "id string, items array<struct<n string, v int>>",
    )
    flat = explode_records(df, "items", {"parent": "id"}, {"name": "n"}, position="at")
    assert flat.columns == ["parent", "at", "name"]
    assert rows(flat) == [("r1", 0, "a"), ("r1", 1, "b")]


def test_field_of_each_reads_one_field(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.createDataFrame(
        [("r1", [("a", 1), ("b", 2)])], "id string, items array<struct<n string, v int>>"
    ).write.parquet(path)
    picked = field_of_each(spark.read.parquet(path), "items", "n")
    assert rows(picked) == [(0, "a"), (1, "b")]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "items:array<struct<n:string>>" in plan
    assert "Exchange" not in plan


def test_last_write_wins_takes_whole_row(spark):
    df = spark.createDataFrame(
        [("f", 1, "u1", "x"), ("f", 3, "u3", None), ("f", 2, "u2", "y"), ("g", 1, "u4", "z")],
        "name string, pos int, url string, note string",
    )
    found = last_write_wins(df, "name", "pos", {"url": "url", "note": "note"})
    assert sorted(rows(found)) == [("f", "u3", None), ("g", "u4", "z")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), max_size=30))
def test_last_write_wins_against_a_loop(spark, writes):
    df = spark.createDataFrame(
        [(name, at, str(value)) for at, (name, value) in enumerate(writes)],
        "name string, at int, value string",
    )
    stored = {}
    for name, value in writes:
        stored[name] = str(value)
    assert dict(rows(last_write_wins(df, "name", "at", {"value": "value"}))) == stored


def test_last_write_wins_combines_before_the_shuffle(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("name"), "id")
    plan = last_write_wins(df, "name", "id", {"id": "id"})._jdf.queryExecution().toString()
    assert "partial_max_by" in plan


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    assert rows(row_count(df)) == [(4,)]
    assert rows(distinct_count(df, "v")) == [(2,)]


def test_preview_with_and_without_order(spark):
    df = spark.range(100).repartition(4)
    assert preview(df).count() == 20
    assert [r[0] for r in rows(preview(df, 3, [F.desc("id")]))] == [99, 98, 97]


def test_missing_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(missing_counts(df, ["a", "b"])) == [(3, 1, 2)]


def test_enforce_required_passes_complete_rows(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert rows(enforce_required(df, ["a"], "row")) == [(1, "x")]


def test_enforce_required_names_what_is_missing(spark):
    df = spark.createDataFrame([(1, None, None)], "a int, b string, c string")
    checked = enforce_required(df, ["a", "b", "c"], "row")
    with pytest.raises(Exception, match="row: missing required keys: b, c"):
        checked.select("a").collect()


@pytest.mark.parametrize("condition", ["a > 1", "a IS NOT NULL", "a = 1 AND b = 'x'", "b LIKE 'x%'"])
def test_enforce_required_is_not_filtered_away(spark, condition):
    path = scratch_dir(spark, "required")
    spark.createDataFrame([(1, "x"), (None, "x"), (2, None)], "a int, b string").write.parquet(path)
    checked = enforce_required(spark.read.parquet(path), ["a", "b"], "row")
    with pytest.raises(Exception, match="missing required keys"):
        checked.filter(condition).collect()


def test_failed_check_keeps_old_output(spark):
    path = scratch_dir(spark, "check")
    spark.range(3).write.parquet(path)
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).alias("id"))
    with pytest.raises(Exception, match="missing required keys"):
        (
            enforce_required(broken, ["id"], "row")
            .withColumn("day", F.lit("d"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day")
            .parquet(path)
        )
    assert spark.read.parquet(path).count() == 3


def test_assert_ready(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert assert_ready(df, ["a"], T.StructType([T.StructField("b", T.StringType())])) is df
    with pytest.raises(CheckFailed, match="c: missing"):
        assert_ready(df, ["a", "c"])
    with pytest.raises(CheckFailed, match="no rows"):
        assert_ready(df.filter("a > 1"), ["a"])


def test_schema_differences():
    text, whole = T.StringType(), T.IntegerType()
    actual = T.StructType([T.StructField("a", text), T.StructField("x", text)])
    expected = T.StructType([T.StructField("a", whole), T.StructField("b", whole)])
    assert schema_differences(actual, expected) == ["a: string instead of int", "b: missing"]


def test_fingerprint_sees_one_changed_value(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    changed = df.withColumn("v", F.when(F.col("id") == 500, 9).otherwise(F.col("v")))
    assert take_fingerprint(df) == take_fingerprint(df.repartition(5))
    assert take_fingerprint(df) != take_fingerprint(changed)


def test_fingerprint_as_data_equals_the_one_taken(spark):
    for df in (spark.range(1000).withColumn("v", F.lit(None).cast("string")), spark.range(0)):
        row = fingerprint(df).first()
        assert take_fingerprint(df) == Fingerprint(row.rows, int(row.checksum))
        assert take_fingerprint(df, checksum=False) == Fingerprint(row.rows)
        assert fingerprint(df, checksum=False).columns == ["rows"]


def test_fingerprint_sees_repeated_rows_and_moved_nulls(spark):
    schema = "a string, b string"
    once = spark.createDataFrame([("x", None), ("y", "y")], schema)
    moved = spark.createDataFrame([(None, "x"), ("y", "y")], schema)
    emptied = spark.createDataFrame([("x", ""), ("y", "y")], schema)
    other = spark.createDataFrame([("x", None), ("z", "z")], schema)
    prints = {take_fingerprint(d) for d in (once, moved, emptied, other)}
    assert len(prints) == 4
    assert take_fingerprint(once.union(once)) != take_fingerprint(other.union(other))


def test_observed_write_scans_once(spark):
    path = scratch_dir(spark, "observed")
    df = spark.range(0, 1000, 1, 4).withColumn("v", F.col("id") * 2)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = df.mapInPandas(counted, df.schema)
    written = observed_write(source, lambda d: d.write.parquet(path), checksum=True)
    assert written == take_fingerprint(df)
    assert seen.value == 1000


def test_observed_write_of_no_rows(spark):
    path = scratch_dir(spark, "observed")
    written = observed_write(spark.range(5).filter("id > 9"), lambda d: d.write.parquet(path), True)
    assert (written.rows, written.checksum) == (0, 0)


def test_verify_raises_on_difference(spark):
    df = spark.range(10)
    fine = take_fingerprint(df)
    assert verify(fine, df, "copy") == fine
    with pytest.raises(CheckFailed, match="copy"):
        verify(fine, spark.range(1, 11), "copy")
